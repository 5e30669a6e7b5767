import random

import numpy as np
from tests.llm.helpers import awkward, empty
from veil.llm import simhash
from veil.llm.components import components


def brute_components(values, links):
    root = {v: v for v in values}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


def clustered(rng, centres, members, flips):
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(members):
            x = c
            for _ in range(rng.randint(0, flips)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(x - (1 << 64) if x >> 63 else x for x in out)


def near(a, b):
    return ((a ^ b) & 0xFFFFFFFFFFFFFFFF).bit_count() <= 2


def test_tree_finds_all_within_the_radius():
    rng = random.Random(2)
    values = [x & 0xFFFFFFFFFFFFFFFF for x in clustered(rng, 5, 60, 4)]
    tree = simhash.BKTree(2)
    for k, v in enumerate(values):
        assert sorted(tree.add(v)) == [i for i in range(k) if near(values[i], v)]


def test_links_lose_nothing(spark):
    rng = random.Random(3)
    values = clustered(rng, 12, 40, 5)
    fps = spark.createDataFrame([(v,) for v in values], "fp bigint")
    want = brute_components(values, [(a, b) for i, a in enumerate(values) for b in values[:i] if near(a, b)])
    for shard in (2048, 3):  # the second passes crowded shards on, level by level
        links = [(r.a, r.b) for r in simhash.near_links(fps, shard=shard).collect()]
        assert all(near(a, b) for a, b in links)
        assert brute_components(values, links) == want


def test_components_of_chains_and_hubs(spark):
    links = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 160)] + [(7, 7), (8, 7), (7, 8)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(51), 0), **dict.fromkeys(range(100, 160), 100)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_fingerprint_by_definition():
    import xxhash

    text = "The  Quick\tbrown\nfox É the quick"
    words = "the quick brown fox É the quick".split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]).encode(), 42) for k in range(len(words) - 2)]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text.encode()) == bits
    assert simhash.fingerprint(b"One two") == xxhash.xxh64_intdigest(b"one two", 42)
    assert simhash.fingerprint(b" \n\t ") == 0


def test_groups_of_awkward_rows(spark):
    docs = awkward(spark, [(20, "SAME  text"), (21, " \n "), (30, "no relation at all to the rest")])
    rows = simhash.near_groups(docs).collect()
    assert len(rows) == docs.count()
    by_id = {(r.doc_id, r.fingerprint): r.component_id for r in rows}
    same, none = f"{simhash.fingerprint(b'same text'):016x}", "0" * 16
    assert by_id[(20, same)] == by_id[(4, same)] == by_id[(None, same)] == 1
    assert by_id[(21, none)] == by_id[(None, none)] == by_id[(3, none)] == 2
    assert [r.component_id for r in rows if r.doc_id == 30] == [30]
    assert [r.component_id for r in rows if r.doc_id == 6] == [5]
    assert simhash.near_groups(empty(spark)).count() == 0


def edited(rng, words, share):
    return [rng.choice("abcdefghij") * 5 if rng.random() < share else w for w in words]


def test_one_of_each_group_stays(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(3, 9))) for _ in range(3000)]
    rows, family = [], {}
    for f in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(150, 400))]
        for k in range(rng.choice([1, 1, 3])):
            rows.append((len(rows), " ".join(edited(rng, base, 0.006 * (k > 0)))))
            family[rows[-1][0]] = f
    docs = awkward(spark).unionByName(awkward(spark).limit(0)).select("doc_id", "text").unionAll(
        spark.createDataFrame([(1000 + i, t) for i, t in rows], "doc_id bigint, text string"))
    kept = simhash.keep_one(docs).collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None and r.doc_id >= 1000]
    assert {family[i - 1000] for i in ids} == set(range(60)) and len(ids) == len(set(ids))
    assert len(ids) <= 63  # nearly every edited copy goes
    small = sorted((str(r.doc_id), len(r.text or "")) for r in kept if r.doc_id is None or r.doc_id < 1000)
    assert [i for i, _ in small] == ["1", "2", "5", "7"]
    assert simhash.keep_one(empty(spark)).count() == 0


def test_large_shards_link_as_pairs_do():
    rng = random.Random(6)
    values = []
    for _ in range(6):
        c = rng.getrandbits(256)
        for _ in range(50):
            x = c
            for _ in range(rng.randint(0, 34)):
                x ^= 1 << rng.randrange(256)
            values.append(x.to_bytes(32, "little"))
    numbers = [int.from_bytes(v, "little") for v in values]
    links = [(i, j) for i in range(len(numbers)) for j in range(i) if (numbers[i] ^ numbers[j]).bit_count() <= 38]
    got = simhash._large_shard(values, 38)
    assert all((numbers[i] ^ numbers[j]).bit_count() <= 38 for i, j in got)
    every = range(len(numbers))
    assert brute_components(every, got) == brute_components(every, links)
    assert simhash.distance_of(0.8) == 38


def jaccard(a, b):
    a, b = (set(zip(*(t.lower().split()[k:] for k in range(5)), strict=False)) for t in (a, b))
    return len(a & b) / len(a | b)


def test_texts_that_share_a_repeated_phrase_stay(spark):
    rng = random.Random(8)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(n))

    line = words(19)
    texts = []
    for repeats in (10, 50, 200):
        texts += [" ".join(f"{line} {words(4)}" for _ in range(repeats)) for _ in range(4)]
    assert max(jaccard(a, b) for i, a in enumerate(texts) for b in texts[:i]) < 0.8
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert simhash.keep_one(docs).count() == len(texts)


def test_groups_are_those_of_exact_similarity(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        for share in (0, 0.005, 0.01, 0.03, 0.05):
            rows.append((len(rows), " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in base)))
    links = [(i, j) for i, a in rows for j, b in rows[:i] if jaccard(a, b) >= 0.8]
    want = brute_components([i for i, _ in rows], links)
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(want[got[i]] == want[i] for i in got)  # no link below the similarity
    met = sum(got[i] == got[j] for i, j in links)
    assert met >= 0.9 * len(links)


def recall(similarity, shingles, bits, pairs=300):
    """Share of random pairs of sets that become candidates."""
    rng = np.random.default_rng(5)
    radius, found = simhash.radius_of(0.8), 0
    for _ in range(pairs):
        both = round(similarity * shingles)
        x = rng.integers(0, 1 << 64, shingles, np.uint64)
        own = (shingles - both) // 2
        sets = x[: both + own], np.concatenate([x[:both], x[both + own :]])
        a, b = (np.unpackbits(np.frombuffer(simhash._wide_print(s), np.uint8), bitorder="little") for s in sets)
        apart = a != b
        found += apart.sum() <= radius and not apart[bits].any(1).all()
    return found / pairs


def test_recall_per_band_of_similarity():
    small, large = (simhash.sampled_bits(simhash.PER_SHARD << width, simhash.radius_of(0.8)) for width in (8, 20))
    assert small.shape[1] == 8 and large.shape[1] == 20
    for bits in (small, large):
        for similarity in (0.8, 0.82, 0.85, 0.9):
            for shingles in (60, 200, 600):
                assert recall(similarity, shingles, bits) >= 0.95


def test_the_last_shards_leave_eight_bits_free(spark):
    """Each level halves the free bits, so a shard of the last one has at most 256 prints."""
    points = spark.range(300).selectExpr("id * 7919 AS fp", "-1L AS free")
    for level, left in enumerate((32, 16, 8)):
        shards = simhash._shards(points, level)
        assert {bin(r.free % 2**64).count("1") for r in shards.select("free").distinct().collect()} == {left}
        points = shards.select("fp", "free").distinct().limit(2000)


def test_crowded_shards_at_all_levels_lose_no_link(spark):
    """Prints that differ in their last bits only go through all levels."""
    import random

    rng = random.Random(6)
    values = {rng.randrange(1 << 11) | (rng.randrange(4) << 60) for _ in range(700)}
    values = [v - (1 << 64) if v >> 63 else v for v in values]
    links = [(r.a, r.b) for r in simhash.near_links(spark.createDataFrame([(v,) for v in values], "fp bigint"), shard=4).collect()]
    near = lambda a, b: bin((a ^ b) % 2**64).count("1") <= 2
    assert all(near(a, b) for a, b in links)

    def groups(pairs):
        root = {v: v for v in values}
        def find(v):
            while root[v] != v:
                v = root[v]
            return v
        for a, b in pairs:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return {v: find(v) for v in values}

    assert groups(links) == groups((a, b) for a in values for b in values if a < b and near(a, b))

def sets_apart(rng, shared, own):
    x = rng.integers(0, 1 << 64, shared + 2 * own, np.uint64)
    return np.concatenate([x[:shared], x[shared : shared + own]]), np.concatenate([x[:shared], x[shared + own :]])


def test_sketches_rule_out_only_what_is_not_similar():
    """At 0.8 and above every pair passes, whatever the size; clearly below none does, up to a thousand shingles."""
    rng = np.random.default_rng(11)
    for shared, own in ((8, 1), (80, 10), (800, 100), (1600, 150), (8000, 1000), (40_000, 5000)):
        for _ in range(40):
            a, b = (np.frombuffer(simhash.parity_sketch(s), np.uint8) for s in sets_apart(rng, shared, own))
            assert np.bitwise_count(a ^ b).sum() <= simhash.sketch_bound(np.array(2 * (shared + own)), 0.8)
    for shared, own in ((75, 15), (750, 150)):
        passed = 0
        for _ in range(100):
            a, b = (np.frombuffer(simhash.parity_sketch(s), np.uint8) for s in sets_apart(rng, shared, own))
            passed += np.bitwise_count(a ^ b).sum() <= simhash.sketch_bound(np.array(2 * (shared + own)), 0.8)
        assert passed <= 1


def test_a_crowd_that_is_not_similar_enough_is_not_handed_on_in_pairs(spark):
    """300 texts near one another, but below 0.8, and two that are similar to one of them."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(300):
        text = list(base)
        for k in rng.sample(range(0, 200, 5), 3):
            text[k] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    for i in (300, 301):
        rows.append((i, rows[7][1] + f" end{i}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    links = [(i, j) for i, a in rows for j, b in rows[:i] if jaccard(a, b) >= 0.8]
    want = brute_components([i for i, _ in rows], links)
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(docs).collect()}
    assert got == want
    nodes = spark.createDataFrame(
        [(i, i, len(s), simhash._wide_print(s), simhash.parity_sketch(s)) for i, t in rows for s in [simhash.shingle_set(t.encode())]],
        "node bigint, label bigint, size bigint, fp binary, sketch binary")
    radius = simhash.radius_of(0.8)
    bits = simhash.sampled_bits(len(rows), radius)
    plain = simhash.similar_candidates(nodes, radius, bits, 0.8, True).count()
    sharp = {(min(r), max(r)) for r in simhash.similar_candidates(nodes.selectExpr("node", "label", "size", "concat(fp, sketch) AS fp"), radius, bits, 0.8, True).collect()}
    near = {(min(p), max(p)) for p in links}
    assert len(near - sharp) <= 0.05 * len(near)
    assert len(sharp) <= 1.5 * len(near) + 50 and plain > 1.2 * len(sharp)


def test_rows_made_by_a_crowd_do_not_grow_with_the_tables(spark):
    """A pair leaves its first common table only; the partners found are those of all tables."""
    rng = np.random.default_rng(13)
    center = np.unpackbits(rng.integers(0, 256, 32, np.uint8))
    prints = [np.packbits(center ^ (rng.random(256) < 0.05)).tobytes() for _ in range(200)]
    nodes = spark.createDataFrame([(i, i, 100, p) for i, p in enumerate(prints)], "node bigint, label bigint, size bigint, fp binary")
    radius = simhash.radius_of(0.8)
    bits = simhash.sampled_bits(200, radius)
    x = np.unpackbits(np.frombuffer(b"".join(prints), np.uint8).reshape(200, -1), axis=1, bitorder="little")
    d = (x[:, None] != x[None]).sum(2)
    met = np.any([(x[:, None, b] == x[None, :, b]).all(2) for b in bits], axis=0) & (d <= radius) & ~np.eye(200, dtype=bool)
    want = set()
    for a in range(200):
        partners = np.flatnonzero(met[a])
        for b in (partners[np.lexsort((partners, d[a, partners]))[0]], partners[0]):
            want.add((min(a, int(b)), max(a, int(b))))
    got = simhash.similar_candidates(nodes, radius, bits, 0.8, False)
    assert {(r.a, r.b) for r in got.collect()} == want
    every = [(r.a, r.b) for r in simhash.similar_candidates(nodes, radius, bits, 0.8, True).collect()]
    assert len(every) == len(set((min(p), max(p)) for p in every)) == met.sum() // 2
