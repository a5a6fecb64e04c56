import random
from collections import defaultdict

import numpy as np
import pytest

from clickpulse.llm.packing import CAPACITIES, pack, pack_documents, pack_texts, sequence_cost


@pytest.mark.parametrize("seed", range(4))
def test_bins_hold_their_pieces_and_shrink(seed):
    rng = random.Random(seed)
    lengths = np.array([rng.choice([rng.randint(0, 100), rng.randint(100, 4096), 4096]) for _ in range(2000)])
    bins, size = pack(lengths)
    held = np.bincount(bins, weights=lengths, minlength=len(size)).astype(int)
    assert (held <= size).all() and set(size.tolist()) <= set(CAPACITIES)
    for h, c in zip(held, size):
        assert c == min(x for x in CAPACITIES if x >= h)
    # no worse than one permitted length alone, and little is left empty
    alone = sum(sequence_cost(4096) for _ in range(len(pack(lengths, (4096,))[1])))
    assert sum(sequence_cost(int(c)) for c in size) <= alone
    assert held.sum() >= 0.97 * size.sum()


def test_cost_decides_the_sizes():
    lengths = np.full(64, 500)
    assert set(pack(lengths, cost=lambda c: c * c)[1].tolist()) == {512}
    assert set(pack(lengths, cost=lambda c: 1.0)[1].tolist()) == {4096}
    assert [x.tolist() for x in pack(np.zeros(0, np.int64))] == [[], []]
    bins, size = pack(np.array([0, 0, 0]))
    assert size[bins].tolist() == [512] * 3 and len(size) <= 3


def test_documents_are_cut_placed_once_and_do_not_overlap(frame):
    rng = random.Random(1)
    rows = [(i, rng.randint(0, 3000)) for i in range(400)] + [(1000, 12_345), (1001, None), (None, 7), (1002, 4096), (5, 10), (5, 10)]
    found = pack_documents(frame(rows, "doc_id long, n_words int"), shard_pieces=100).collect()
    words, bins = defaultdict(int), defaultdict(list)
    for r in found:
        words[r.doc_id] += r.n_words
        bins[r.bin_id].append(r)
    want = defaultdict(int)
    for d, n in rows:
        want[d] += n or 0
    assert words == want and len({b >> 32 for b in bins}) >= 3
    assert [(r.piece, r.first_word, r.n_words) for r in sorted(found, key=str) if r.doc_id == 1000 and r.piece == 3] == [(3, 12288, 57)]
    for placed in bins.values():
        end = 0
        for r in sorted(placed, key=lambda r: (r.bin_offset, r.n_words)):
            assert r.bin_offset >= end and r.capacity == placed[0].capacity
            end = r.bin_offset + r.n_words
        assert end <= placed[0].capacity


def test_texts_and_reruns_agree(frame, odd_docs):
    docs = frame(odd_docs)
    found = sorted(map(str, pack_texts(docs).collect()))
    assert found == sorted(map(str, pack_texts(docs).collect()))
    assert sum(1 for r in pack_texts(docs).collect() if r.doc_id == 4) == 2 * -(-30_000 // 4096)


def test_sequences_hold_the_tokens_of_all_texts(frame, odd_docs):
    """Pieces put together again are the texts' ids, long texts and repeated
    rows among them."""
    import public_tokenizers

    from clickpulse.llm.packing import pack_tokens
    from clickpulse.llm.tokenbin import END_ID, encoder

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = frame(odd_docs)
    found = pack_tokens(docs, path, capacities=(64, 256), shard_pieces=100, shard_tokens=9_000).collect()
    again = pack_tokens(docs, path, capacities=(64, 256), shard_pieces=100, shard_tokens=9_000).collect()
    assert sorted(map(str, found)) == sorted(map(str, again)) and len({b.bin_id for b in found}) == len(found)
    assert len({b.bin_id >> 32 for b in found}) > -(-sum(len(b.doc_ids) for b in found) // 100)
    texts, pieces = defaultdict(list), defaultdict(list)
    for d, t in odd_docs:
        texts[d].append([*np.frombuffer(encoder(path).whole(t or ""), "<u2").tolist(), END_ID])
    for b in found:
        assert b.n_tokens == len(b.ids) <= b.capacity == min(c for c in (64, 256) if c >= len(b.ids))
        assert b.starts[0] == 0 and b.starts == sorted(b.starts)
        for d, first, low, high in zip(b.doc_ids, b.first_tokens, b.starts, [*b.starts[1:], len(b.ids)]):
            pieces[d, first].append(b.ids[low:high])
    want = defaultdict(list)
    for d, some in texts.items():
        for ids in some:
            for first in range(0, len(ids), 256):
                want[d, first].append(ids[first:first + 256])
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    assert pack_tokens(frame([], "doc_id long, text string"), path).count() == 0


def _plain_best_fit(lengths, sizes, cost):
    """Every bin looked at for every piece: the open bin of least room, else a
    new one; the packing of least cost over all longest sizes."""
    best = None
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    for top in range(1, len(sizes) + 1):
        allowed, bins = sizes[:top], []

        def place(some, opened, bins):
            left = sum(lengths[i] for i in some)
            for i in some:
                left -= lengths[i]
                fits = [b for b in bins if b[0] >= lengths[i] and b[0] > 0]
                if fits:
                    b = min(fits, key=lambda b: b[0])
                else:
                    able = [c for c in opened if c >= lengths[i]] or [opened[-1]]
                    c = min(able, key=lambda c: (cost(c) / min(c, max(1, lengths[i] + left)), -c))
                    b = [c, 0]
                    bins.append(b)
                b[0] -= lengths[i]
                b[1] += lengths[i]
            return bins

        big = [i for i in order if lengths[i] > allowed[-1]]
        rest = [i for i in order if lengths[i] <= allowed[-1]]
        held = place(big, allowed if allowed[-1] == sizes[-1] else [*allowed, sizes[-1]], []) + place(rest, allowed, [])
        shrunk = sorted(min(c for c in sizes if c >= b[1]) for b in held)
        total = sum(cost(c) for c in shrunk)
        if best is None or total < best[0]:
            best = total, shrunk
    return best[1]


@pytest.mark.parametrize("seed", range(6))
def test_same_sequences_as_a_plain_best_fit(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randint(1, 60), rng.randint(60, 400), 400]) for _ in range(rng.randint(1, 120))]
    sizes = [50, 100, 200, 400]
    found = pack(np.array(lengths), sizes)[1]
    assert sorted(found.tolist()) == _plain_best_fit(lengths, sizes, sequence_cost)
