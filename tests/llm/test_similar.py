"""Near duplicates of documents and vectors, and top-k search, against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpuskit.llm import binary_codes, common, simhash, text_figures, threshold_search
from corpuskit.llm.vectors import is_valid


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items, linked):
    """Smallest index reachable, by items."""
    root = list(range(len(items)))
    changed = True
    while changed:
        changed = False
        for i in range(len(items)):
            for j in range(len(items)):
                if linked(items[i], items[j]) and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(rng.choice([5, 60, 400]))) for _ in range(25)]
    out = list(base)
    for text in base:
        for _ in range(rng.choice([0, 1, 4])):
            copy = text.split()
            copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
    return out + [base[0], base[0].upper(), "", None, "  \t\n", "one", "one two three", "long " * 30_000]


def test_fingerprints(texts):
    for text in texts[:40] + texts[-8:]:
        assert simhash.fingerprint(text) % 2**64 == brute_fingerprint(text)


@pytest.mark.parametrize("cell", [simhash.CELL, 3])
def test_near_duplicate_documents(spark, texts, cell, monkeypatch):
    monkeypatch.setattr(simhash.links, "__defaults__", (4, simhash.BLOCKS, cell))
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, fp string")
    prints = [brute_fingerprint(t) for t in texts]
    root = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    rows = simhash.near_duplicates(docs).collect()
    assert {(r.doc_id, r.fp % 2**64, r.component_id) for r in rows} == {(i, prints[i], root[i]) for i in range(len(texts))}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root))


def test_documents_with_odd_ids(spark):
    rows = [(7, "a b c d e"), (7, "a b c d e"), (7, "quite another text here now"), (None, "a b c d e"), (None, "third one"), (None, "third one")]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id bigint, text string, n int, _id int, _hash int")
    assert sorted(str(r.component_id) for r in simhash.near_duplicates(docs).collect()) == ["7"] * 4 + ["None"] * 2
    assert sorted(map(str, simhash.one_of_each(docs).collect())) == sorted(
        map(str, docs.distinct().where("doc_id is not null or text = 'third one'").collect())
    )
    assert simhash.near_duplicates(docs.where("false")).count() == 0
    assert simhash.one_of_each(docs.where("false")).count() == 0


def test_pivots_never_lose_a_near_pair():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 3_000, dtype=np.uint64)
    b = a.copy()
    for _ in range(4):
        b ^= np.uint64(1) << rng.integers(0, 64, 3_000, dtype=np.uint64)
    assert len(simhash.near(a, b, simhash.pivot_table(a), simhash.pivot_table(b), 4)) == 3_000
    far = rng.permutation(b)
    left = np.abs(simhash.pivot_table(a) - simhash.pivot_table(far)).max(axis=1) <= 4
    assert left.mean() < 0.01


def test_components_of_a_chain(spark):
    order = random.Random(4).sample(range(400), 400)
    edges = list(zip(order[:300], order[1:300])) + list(zip(order[300:], order[301:]))
    found = dict(common.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert found == {n: min(order[:300]) for n in order[:300]} | {n: min(order[300:]) for n in order[300:]}
    assert common.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def vectors(rng, groups=30, dim=24):
    base = rng.normal(size=(groups, dim))
    rows = []
    for row in base:
        for _ in range(rng.integers(1, 7)):
            rows.append(row + rng.normal(size=dim) * rng.choice([0, 0.02, 0.1]))
    return np.array(rows)


ODD = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [0.0] * 23, [None] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0], [1e300] * 24, [1e-300] * 24]


@pytest.mark.parametrize("cell", [binary_codes.CELL, 3])
def test_near_duplicate_vectors(spark, cell):
    rng = np.random.default_rng(8)
    matrix = vectors(rng)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(matrix)] + [(1000 + i, v, 1) for i, v in enumerate(ODD)]
    rows += [(2000, matrix[0].tolist(), 1), (None, matrix[1].tolist(), 1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, n int").repartition(5)
    got = {r.vec_id: r for r in binary_codes.near_duplicates(table, cell=cell).collect()}
    assert len(got) == len(rows)
    ids = list(range(len(matrix))) + [2000]
    unit = np.vstack([matrix, matrix[:1]])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    link = (unit @ unit.T >= 0.95) & ~np.eye(len(unit), dtype=bool)
    root = brute_components(list(range(len(unit))), lambda a, b: link[a, b])
    found = sum(got[i].n_links for i in ids)
    assert 0.98 * link.sum() <= found <= link.sum()
    assert np.mean([got[i].component_id == ids[root[k]] for k, i in enumerate(ids)]) > 0.98
    for i in range(6):
        assert (got[1000 + i].n_links, got[1000 + i].component_id, got[1000 + i].kept) == (0, 1000 + i, True)
    # [1, 2] and [2, 4] point the same way, as do the very large and the very small vector.
    assert [(got[i].n_links, got[i].component_id) for i in (1006, 1007, 1008, 1009)] == [(1, 1006), (1, 1006), (1, 1008), (1, 1008)]
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)
    assert binary_codes.near_duplicates(table.where("false")).count() == 0
    assert table.where(is_valid(F.col("embedding")) & F.col("vec_id").between(1000, 1009)).count() == 5


@pytest.mark.parametrize("case", ["two", "one group", "common direction"])
def test_near_copies_that_share_a_direction(spark, case):
    rng = np.random.default_rng(13)
    one = rng.normal(size=64)
    matrix = {
        "two": one + 0.05 * rng.normal(size=(2, 64)),
        "one group": np.vstack([one + 0.05 * rng.normal(size=(270, 64)), rng.normal(size=(30, 64))]),
        "common direction": 4 + np.repeat(rng.normal(size=(60, 64)), 5, axis=0) + 0.2 * rng.normal(size=(300, 64)),
    }[case]
    unit = binary_codes.normed(matrix)
    link = (unit @ unit.T >= 0.95) & ~np.eye(len(unit), dtype=bool)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r for r in binary_codes.near_duplicates(table).collect()}
    assert 0.99 * link.sum() <= sum(r.n_links for r in got.values()) <= link.sum()
    root = brute_components(list(range(len(unit))), lambda a, b: link[a, b])
    assert [got[i].component_id for i in range(len(unit))] == root


def test_one_large_group_keeps_its_links():
    rng = np.random.default_rng(14)
    unit = binary_codes.normed(rng.normal(size=64) + 0.05 * rng.normal(size=(300, 64)))
    codes = binary_codes.learn_rotation(unit).codes(unit)
    differ = np.bitwise_count(codes[:, None] ^ codes[None, :])
    assert (unit @ unit.T).min() >= 0.95 and differ.max() <= 8


def test_rotation_is_orthogonal_and_better_than_none():
    rng = np.random.default_rng(5)
    unit = binary_codes.normed(rng.normal(size=(800, 16)) * np.linspace(3, 0.3, 16))
    turned = binary_codes.learn_rotation(unit)
    assert np.allclose(turned.axes.T @ turned.axes, np.eye(16), atol=1e-8)

    def loss(rotation):
        kept = (unit - rotation.mean) @ rotation.axes
        return np.square(np.sign(kept) - kept).sum()

    plain = binary_codes.learn_rotation(unit, rounds=0)
    assert loss(turned) < loss(plain)


@pytest.mark.parametrize("block", [threshold_search.DATA_BLOCK, 7])
def test_top_k(spark, block):
    rng = np.random.default_rng(11)
    matrix = rng.normal(size=(120, 6)).round(1)
    matrix[40] = 0
    rows = [(i, v.tolist(), 1) for i, v in enumerate(matrix)] + [(500 + i, v, 1) for i, v in enumerate(ODD[:7])]
    rows += [(40, matrix[3].tolist(), 1), (None, matrix[1].tolist(), 1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score int")
    got = threshold_search.top_k(table, F.col("vec_id") % 10 == 0, 4, query_block=5, data_block=block)
    found = sorted(tuple(r) for r in got.where("query_id <> 40").collect())
    ints = np.floor(matrix * 1024).astype(int)
    ids = list(range(120)) + [40]
    ints = np.vstack([ints, ints[3:4]])
    want = []
    for q in (i for i in range(0, 120, 10) if i != 40):
        scored = sorted((-int(ints[q] @ ints[k]), ids[k], k) for k in range(121) if ids[k] != q)
        want += [(q, n + 1, i, -s) for n, (s, i, _) in enumerate(scored[:4])]
    assert found == sorted(want)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    few = threshold_search.top_k(table.where("vec_id < 3"), F.col("vec_id") == 0, 10).collect()
    assert len(few) == 2
    assert threshold_search.top_k(table.where("false"), F.col("vec_id") == 0).count() == 0


def test_threshold_stops_early():
    rng = np.random.default_rng(6)
    data = rng.integers(-50, 50, size=(4_000, 3))
    data[7] = [1000, 1000, 1000]
    block = threshold_search.SortedLists(np.arange(4_000), data)
    read = []
    block.vectors = Counted(data, read)
    ids, scores = block.top(-1, np.array([5, 4, 3]), 1)
    assert (ids.tolist(), scores.tolist()) == ([7], [12_000]) and sum(read) < 400


class Counted(np.ndarray):
    """Counts the rows read by random access."""

    def __new__(cls, data, read):
        out = np.asarray(data).view(cls)
        out.read = read
        return out

    def __array_finalize__(self, other):
        self.read = getattr(other, "read", None)

    def __getitem__(self, key):
        if isinstance(key, np.ndarray):
            self.read.append(len(key))
        return np.asarray(super().__getitem__(key))


def test_different_vectors_under_one_id(spark):
    draw = np.random.default_rng(4)
    a, b = draw.normal(size=(2, 32))
    rows = [(5, a.tolist()), (5, b.tolist()), (6, (a + 0.01).tolist()), (4, (b + 0.01).tolist()), (9, draw.normal(size=32).tolist())]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = binary_codes.near_duplicates(table).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == [
        (4, 1, 4, True), (5, 1, 4, False), (5, 1, 5, True), (6, 1, 5, False), (9, 0, 9, True),
    ]
    alone = binary_codes.near_duplicates(table.where("vec_id <> 4")).collect()
    assert sorted((r.vec_id, r.n_links) for r in alone) == [(5, 0), (5, 1), (6, 1), (9, 0)]


@pytest.mark.parametrize("words", [0, 1, 3, 4, 5, 900])
def test_fingerprints_of_long_texts_do_not_depend_on_pieces(words, monkeypatch):
    text = " \n".join(f"Wörd{n % 97}" for n in range(words))
    tokens = text.encode().lower().split()
    grams = [b" ".join(tokens[n : n + 4]) for n in range(max(1, len(tokens) - 3))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    for size in (3, 50, 10_000):
        monkeypatch.setattr(simhash, "pieces", lambda text, size=size: text_figures.pieces(text, size))
        assert simhash.fingerprint(text) % 2**64 == want


def test_more_blocks_find_the_same_groups(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, 300), x -> (x * 7919 + id div 4 * 31 + if(x = id % 4 * 50, 1, 0)) % 1000)) as text")
    rows = [sorted(map(tuple, simhash.near_duplicates(docs, blocks=b).collect())) for b in (6, 8)]
    assert rows[0] == rows[1] and len({r[2] for r in rows[0]}) < 400
