import binascii
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import clashing
from veil.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """Root and, for each leaf, its siblings, by the definition."""
    level, paths, owners = list(leaves), [[] for _ in leaves], [[k] for k in range(len(leaves))]
    while len(level) > 1:
        above, held = [], []
        for k in range(0, len(level), 2):
            run = level[k : k + 2]
            if len(run) == 2:
                for o in owners[k]:
                    paths[o].append((">", run[1]))
                for o in owners[k + 1]:
                    paths[o].append(("<", run[0]))
            above.append(sha(*run))
            held.append([o for own in owners[k : k + 2] for o in own])
        level, owners = above, held
    return level[0], paths


def brute(rows):
    """Rows (doc_id, text, lang, source, n_chars) to the columns of the contract."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, n: sha(*map(field, (r[0], r[3], r[2], n, r[1])))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((leaf(r, r[4]), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    low = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        low[g] = tree([h for h, _ in groups[g]])
    root, tops = tree([low[g][0] for g in order])
    out = []
    for g, top in zip(order, tops, strict=True):
        for (h, r), own in zip(groups[g], low[g][1], strict=True):
            path = own + top
            changed = r[4] if r[4] is None or r[0] is None or binascii.crc32(str(r[0]).encode()) % 7 else r[4] + 1
            out.append((r[0], h, low[g][0], root, sha(*(d for _, d in path)), changed == r[4]))
    return sorted(out, key=repr)


def found(df, **more):
    rows = merkle.manifest(df, **more).collect()
    assert all(r.verified == (r.folded_root == r.root) for r in rows)
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in rows), key=repr)


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 9, 31, 33, 100])
def test_positions_are_the_order_of_completion(n):
    """Appending leaf by leaf and closing the ragged edge last gives the closed form."""
    log = []
    for k in range(n):
        log.append((0, k))
        level, index = 0, k
        while index & 1:
            level, index = level + 1, index >> 1
            log.append((level, index))
    for level in range(1, merkle.levels_of(n) + 1):
        last = ((n - 1) >> level)
        if (last + 1) << level > n:
            log.append((level, last))
    assert [merkle.position(level, index, n) for level, index in log] == list(range(len(log)))


@pytest.mark.parametrize("block", [1, 2, 9])
def test_equals_brute_force(spark, block):
    rng = random.Random(13)
    sizes = {"en": 37, "de": 16, None: 5, "fr": 1, "": 2, "zz": 9}
    rows = [(1000 * i + k, f"text {k} é" * rng.randrange(0, 4), lang, rng.choice(["a", None]), rng.choice([k, None])) for i, (lang, n) in enumerate(sizes.items()) for k in range(n)]
    rng.shuffle(rows)
    assert found(spark.createDataFrame(rows, SCHEMA), bits=block) == brute(rows)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "a", "en", "s", 1)] * 3 + [(None, "b", "en", "s", 2), (None, None, None, None, None), (2, "word " * 60000, "en", None, 7), (-5, "", "de", "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("grp", "key", "node", "place", "path", "block", "part", "row", "tampered"):
        df = df.withColumn(c, F.lit("clash"))
    assert found(clashing(df)) == brute(rows)


def test_one_row_and_no_row(spark):
    one = [(7, "x", "en", "s", 1)]
    got = found(spark.createDataFrame(one, SCHEMA))
    assert got == brute(one) and got[0][1] == got[0][2] == got[0][3]
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_log_holds_every_node_once(spark):
    rows = spark.range(1500).selectExpr("'g' AS grp", "id AS place", "1500L AS n", "sha2(cast(id AS string), 256) AS node")
    tables, roots = merkle._grown(rows, "test-log", [])
    assert roots.count() == 1 and len(tables) == 2
    log = merkle.log(spark, tables).orderBy("position").collect()
    nodes = sum(-(-1500 >> level) for level in range(merkle.levels_of(1500) + 1))
    assert [r.position for r in log] == list(range(nodes))
    assert log[-1].digest == roots.first().subroot == tree([sha(str(k)) for k in range(1500)])[0]
