import hashlib
import random

import numpy as np
import pyarrow as pa

from clickpulse.llm.fingerprints import edited, fingerprint_report, likeness, packed, sketch
from tests.llm.brute import jaccard, shingle_set


def test_whole_small_table(spark, read):
    from tests.conftest import SF_SMALL
    rows = sorted(((r.doc_id, r.text or "") for r in read("documents")), reverse=True)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(5)
    found = {r.doc_id: r for r in fingerprint_report(docs).collect()}
    assert len(found) == len(rows)
    miss, by_text = [], {}
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        r, new = found[doc_id], edited(text, following)
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        miss.append(r.near_edited - jaccard(shingle_set(text, 5), shingle_set(new, 5)))
        miss.append(r.near_next - jaccard(shingle_set(text, 5), shingle_set(following, 5)))
    assert abs(np.mean(miss)) < 0.02 and np.abs(miss).max() < 0.2


def test_edited_text():
    assert edited("abcdef", "XYZW") == "abcXYZ" and edited("abcde", "X") == "abcX" and edited("", "X") == ""
    assert edited("日本語", "éa") == "日本é"


def test_one_document_follows_itself_and_ties_meet(frame):
    one = fingerprint_report(frame([(5, "a b c d e f")])).collect()[0]
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"a b c a b c"[:6] + b"a b c").hexdigest()
    rows = [(None, None), (None, "x"), (2, ""), (2, ""), (1, "one two three")]
    found = fingerprint_report(frame(rows)).collect()
    assert len(found) == 5 and {r.fingerprint for r in found if r.n_chars == 0} == {""}


def test_estimate_is_unbiased():
    rng = random.Random(9)
    for share in (0.0, 0.3, 0.6, 0.9):
        found = []
        for _ in range(40):
            same = [f"s{rng.random()}" for _ in range(int(400 * share))]
            a, b = (" ".join(same + [f"u{rng.random()}" for _ in range(400 - len(same))]) for _ in range(2))
            (la, ka), (lb, kb) = (sketch(pa.array([t])) for t in (a, b))
            found.append(likeness(la, ka, lb, kb)[0] - jaccard(shingle_set(a, 5), shingle_set(b, 5)))
        assert abs(np.mean(found)) < 0.03


def test_short_texts_fill_all_bins():
    low, known = sketch(pa.array(["only", "only", "", None, "a b c d e f g"]))
    text = packed(low, known)
    assert known.tolist() == [True, True, False, False, True] and text[0] == text[1] and text[2] == text[3] == ""
    assert len(text[0]) == 256 and len(set(low[0])) == 1
