import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import awkward, empty
from veil.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def placed(plan, counts):
    """(sequence, offset, length) of every piece."""
    out = []
    for length, n in counts.items():
        rows = [r for r in plan.rows if r[0] == length]
        starts = [r[1] for r in rows]
        assert starts[0] == 0
        for rank in range(n):
            _, first, sequence, each, offset = rows[np.searchsorted(starts, rank, side="right") - 1]
            nth = rank - first
            out.append((sequence + nth // each, offset + nth % each * length, length))
    return out


@pytest.mark.parametrize("case", range(12))
def test_plans_are_gapless_and_near_the_least(case):
    rng = random.Random(case)
    sizes = [rng.choice([rng.randint(1, 1024), rng.randint(1, 150), rng.choice([300, 341, 512, 1024])]) for _ in range(rng.choice([1, 5, 300, 3000]))]
    counts = Counter(sizes)
    plan = packing.make_plan(dict(counts))
    by_sequence = defaultdict(list)
    for sequence, offset, length in placed(plan, counts):
        by_sequence[sequence].append((offset, length))
    assert len(by_sequence) == plan.sequences
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    greedy = packing._Packer(dict(counts), 1024)
    for length in sorted(counts, reverse=True):
        greedy.best_fit(length)
    assert plan.sequences <= max(greedy.sequences + 1, 1.002 * greedy.sequences)


def test_configurations_beat_best_fit_where_sizes_are_few():
    counts = {k: 130 for k in range(330, 360)}
    greedy = packing._Packer(dict(counts), 1024)
    for length in sorted(counts, reverse=True):
        greedy.best_fit(length)
    assert packing.make_plan(counts).sequences < greedy.sequences


def test_linear_grouping_has_equal_groups():
    groups = packing.grouped({500: 10, 400: 7, 300: 3}, 4)
    assert sum(n for _, _, n in groups) == 20
    assert groups[0] == (500, 500, 10)  # two groups of five, of one size
    assert all(low <= size for size, low, _ in groups)


def test_plan_of_a_tiny_programme_is_optimal():
    # Nine pieces of 512 and six of 341, 341 and 342: three per sequence.
    assert packing.make_plan({512: 9, 341: 4, 342: 2}).sequences == 5 + 2


def test_pieces_and_places(spark):
    docs = awkward(spark, [(10 + k, "some words again " * (k * 37 % 900)) for k in range(60)])
    rows = packing.pack_documents(docs, PATH, keep_ids=True).collect()
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        begin, end, piece = 0, len(ids) % 1024 or 1024, 0
        while begin < len(ids):
            part = np.array(ids[begin:end], "<u4").tobytes()
            want[(r.doc_id, piece, begin, end - begin, zlib.crc32(part), part)] += 1
            begin, end, piece = end, end + 1024, piece + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= -(-sum(r.length for r in rows) // 1024) + 2


def test_empty_table(spark):
    assert packing.pack_documents(empty(spark), PATH).count() == 0
