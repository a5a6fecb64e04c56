"""Votes of the license scan ask for no more than the stated share of a wording."""

from clickpulse.llm.licenses import MIN_COVER, TEMPLATES, may_differ, scan_licenses


def test_four_of_twenty_words_may_differ(frame):
    notice = next(t for t in TEMPLATES if t.label == "mit" and len(t.words) == 20)
    changed = [f"x{i}" if i in (4, 8, 12, 16) else w for i, w in enumerate(notice.words)]
    filler = " ".join(f"w{i}" for i in range(50))
    rows = [(1, f"{filler} {' '.join(changed)} {filler}"), (2, f"{filler} gnu general public license {filler}"),
            (3, f"{filler} gnu affero general public license"), (4, f"gnu lesser general public license {filler}")]
    found = {r.doc_id: r for r in scan_licenses(frame(rows)).collect()}
    assert found[1].labels == "mit" and found[1].score == 0.8 and found[1].n_base == 0
    assert found[2].labels == "gpl"
    assert found[3].labels == "agpl,gpl" and found[4].labels == "gpl,lgpl"


def test_share_is_exact():
    for t in TEMPLATES:
        n = len(t.words)
        assert may_differ(t, MIN_COVER) == (0 if t.exact or t.whole else n - (4 * n + 4) // 5)


def test_copies_are_found_wherever_they_begin(frame):
    """Exact copies score 1 and copies with the allowed changes keep their
    label, at every place in a text; so do copies with a few words more."""
    import random

    rng, rows, labels = random.Random(5), [], {}
    notices = [t for t in TEMPLATES if len(t.words) >= 20]
    for t in notices:
        for at in range(26):
            filler = [f"w{i}" for i in range(at)]
            changed = list(t.words)
            for i in rng.sample(range(len(changed)), may_differ(t, MIN_COVER)):
                changed[i] = "other"
            longer = list(t.words)
            for i in sorted(rng.sample(range(1, len(longer)), 3), reverse=True):
                longer.insert(i, "more")
            for words, least in ((t.words, 1.0), (changed, MIN_COVER), (longer, 1.0)):
                labels[len(rows)] = t.label, least
                rows.append((len(rows), " ".join([*filler, *words, *filler[::-1], "end"])))
    for r in scan_licenses(frame(rows)).collect():
        label, least = labels[r.doc_id]
        assert label in r.labels.split(",") and r.score >= least, rows[r.doc_id]
