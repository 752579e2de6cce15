"""Pieces, token ids, packing and token files: exact round trips, brute force, unusual rows."""

import io
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpuskit.llm import packing, sampled_pieces, token_files
from corpuskit.llm.token_ids import PieceEncoder, array_groups, default_path

ODD = [
    None, "", " ", "\n", "a  b", "  a b ", "a \n b", "a\n b\n\nc", "e ́ z", "it's they'll  we've\t\tq", "日本 語　テスト",
    "<|endoftext|> a<|endoftext|>b <|startoftext|>", "a\x1cb \x1c c", "ΟΔΟΣ ΟΔΟΣ.", "İ i̇ ﬁ", "a b", "a\xa0 \u0085 c",
    "word.\nNext, one.. two., x", "É. È, Ñandú. straße, Ÿ", "a\x00b, c", "KELVIN K Å", "end.", "end, ", "a.b, c.", "IT'S, don't. X's",
    "\nfoo\nbar", "µm ªº ×÷ 5 x,y", ",.,", "a,.,. b", "É. é, óx", "a\tb\t c\r\nd", "x\n", "été, là.", "👩‍👩‍👧 👍🏽", "a​b", "▁x ▁▁ y▁\n▁",
    "x" * 3_000, "word " * 30_000, "," * 50 + " x" + "." * 40,
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, -1, "k") for i, t in enumerate(ODD)] + [(5, ODD[5], -1, "k"), (None, "no id", -1, "k")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, length int, piece_ids string").repartition(3)


@pytest.fixture(scope="module")
def corpus_texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    return [r.text for r in rows]


@pytest.mark.parametrize(("name", "drops"), [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_ids_equal_the_whole_texts(corpus_texts, name, drops):
    plain = Tokenizer.from_file(default_path(name))
    rng = random.Random(9)
    mixed = ["".join(rng.choice("aB é\n\t.,' 1\x00-Ω") for _ in range(30)) for _ in range(3_000)]
    for most in (10**6, 50):
        pieces = PieceEncoder(default_path(name), drops, most)
        for texts in (ODD, corpus_texts, mixed):
            got = [ids for group in array_groups(pa.array(texts, pa.string()), 20_000) for ids in pieces.encode(group, 1)]
            assert [g.tolist() for g in got] == [plain.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


# Sampled pieces


def test_sampling_follows_the_lattice():
    model = sampled_pieces.PieceLattice(default_path("piece_bpe_32k.model"), theta=0.4)
    unit = " there"

    def paths(at):
        """All segmentations from a position with their weights."""
        if at == len(unit):
            return [((), 1.0)]
        found = []
        for end in range(at + 1, len(unit) + 1):
            n = model.ids.get(unit[at:end].replace(" ", sampled_pieces.SPACE))
            if n is not None:
                found += [((n, *rest), model.weight[n] * w) for rest, w in paths(end)]
        return found

    exact = paths(0)
    total = sum(w for _, w in exact)
    n = 40_000
    texts = pa.array(["there"] * n)
    drawn = Counter(tuple(x.tolist()) for x in model.sample(texts, sampled_pieces.mixed(np.arange(n, dtype=np.uint64))))
    assert set(drawn) <= {p for p, _ in exact}
    for path, weight in exact:
        share = weight / total
        assert abs(drawn[path] / n - share) < 5 * (share * (1 - share) / n) ** 0.5 + 1e-9


def test_lattice_of_many_units_equals_one_by_one(corpus_texts):
    model = sampled_pieces.PieceLattice(default_path("piece_bpe_32k.model"))
    words = list({" " + w for t in corpus_texts[:40] for w in t.split()} | {"\n", "a\tb", "plain"})
    for word in words:
        model.units[word]
    model.settle()
    bounds = np.append(np.flatnonzero(model.first < 0), len(model.first))
    edges = np.append(model.first[model.first >= 0], len(model.piece))
    assert (np.diff(edges) > 0).all()
    for word, end in zip(words, model.ends.tolist()):
        base = int(bounds[np.searchsorted(bounds, end, "right") - 1])
        first, chance, before, piece = model.filtered_alone(word)
        assert end - base == len(first) - 1
        a = model.first[base + 1]
        b = edges[np.searchsorted(edges, model.first[end]) + 1]
        assert model.piece[a:b].tolist() == piece.tolist() and (model.before[a:b] - base).tolist() == before.tolist()
        assert np.allclose(model.chance[a:b], chance, atol=2e-4)


def test_slices_of_arrays(corpus_texts):
    """Groups of texts are slices of a larger array."""
    model = sampled_pieces.PieceLattice(default_path("piece_bpe_32k.model"))
    texts = pa.array([*ODD, *corpus_texts], pa.string())
    seeds = np.arange(len(texts)).astype(np.uint64)
    whole = [x.tolist() for x in model.sample(texts, seeds)]
    at, parts = 0, []
    for group in array_groups(texts, 10_000):
        parts += [x.tolist() for x in model.sample(group, seeds[at : at + len(group)])]
        at += len(group)
    assert parts == whole
    assert [model.decode(ids) for ids in whole] == [t or "" for t in texts.to_pylist()]


def test_sampled_pieces_are_lossless_and_reproducible(spark, odd, corpus_texts):
    encoded = sampled_pieces.encode(odd)
    assert encoded.columns == ["doc_id", "text", "length", "piece_ids"]
    decoded = sampled_pieces.decode(encoded)
    assert decoded.where("decoded = coalesce(text, '')").count() == len(ODD) + 2
    one = {(r.doc_id, r.text): r.piece_ids for r in encoded.collect()}
    other = {(r.doc_id, r.text): r.piece_ids for r in sampled_pieces.encode(odd.repartition(1)).collect()}
    assert one == other
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(corpus_texts)], "doc_id bigint, text string")
    again = sampled_pieces.decode(sampled_pieces.encode(docs, seed=5))
    assert again.where("decoded = text").count() == len(corpus_texts)
    a, b = (sampled_pieces.encode(docs, seed=s).select("doc_id", F.col("piece_ids").alias(f"p{s}")) for s in (0, 1))
    assert a.join(b, "doc_id").where("p0 = p1").count() < len(corpus_texts) / 10
    assert sampled_pieces.decode(sampled_pieces.encode(odd.where("false"))).count() == 0
    assert sampled_pieces.decode(spark.createDataFrame([(None,)], "piece_ids array<int>")).first().decoded is None


# Packing


def brute_best_fit(sizes, window):
    """One piece after another into the tightest window; contents of all windows."""
    open_ = []
    for size in sorted(sizes, reverse=True):
        fits = [w for w in open_ if window - sum(w) >= size]
        if fits:
            min(fits, key=lambda w: window - sum(w)).append(size)
        else:
            open_.append([size])
    return open_


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_equals_one_by_one(seed):
    rng = random.Random(seed)
    window = rng.choice([16, 31, 64])
    sizes = [min(window, int(rng.expovariate(3 / window)) + 1) for _ in range(300)] + [window // 2] * 40
    contents = {}
    for size, a, b, first, offset, each in packing.best_fit(dict(Counter(sizes)), window):
        for n in range(b - a):
            contents.setdefault(first + n // each, []).append((offset + n % each * size, size))
    assert Counter(s for w in contents.values() for _, s in w) == Counter(sizes)
    for pieces in contents.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= window
    want = brute_best_fit(sizes, window)
    assert len(contents) == len(want)
    # Windows with one remaining capacity are interchangeable, so their fill is the same, not their contents.
    assert Counter(sum(s for _, s in w) for w in contents.values()) == Counter(map(sum, want))


def test_packed_documents(spark, odd):
    window = 64
    rows = packing.packed(odd, window=window).collect()
    plain = Tokenizer.from_file(default_path("word_bpe_49k.json"))
    for doc_id, text in [*enumerate(ODD), (None, "no id")]:
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        pieces = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id == doc_id)
        want = [(a, min(window, len(ids) - a), zlib.crc32(ids[a : a + window].tobytes()), len(ids)) for a in range(0, len(ids), window)]
        assert pieces == sorted(want * (2 if doc_id == 5 else 1))
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in filled.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= window
    assert sorted(filled) == list(range(len(filled)))
    assert len(filled) == len(brute_best_fit([r.length for r in rows], window))
    assert packing.packed(odd.where("false")).count() == 0


# Token files


class Source(io.BytesIO):
    """Counts the bytes read."""

    total = 0

    def read(self, n=-1):
        data = super().read(n)
        self.total += len(data)
        return data


def written(documents, frame_ids=100):
    kept = io.BytesIO()
    kept.close = lambda: None
    writer = token_files.Writer(kept, frame_ids=frame_ids)
    for doc_id, ids in documents:
        writer.add(doc_id, np.array(ids, np.uint32))
    writer.close()
    return kept.getvalue()


def test_file_format():
    rng = random.Random(4)
    documents = [(i, [rng.randrange(50_000) for _ in range(rng.choice([1, 30, 250]))]) for i in range(200)] + [(None, [7]), (199, [])]
    data = written(documents)
    reader = token_files.Reader(io.BytesIO(data), len(data))
    assert [(d, ids.tolist()) for d, ids in reader.documents()] == documents
    source = Source(data)
    few = list(token_files.Reader(source, len(data)).documents([150]))
    assert [(d, ids.tolist()) for d, ids in few] == [documents[150]] and source.total < len(data) / 3
    # Any zstandard reader gets the ids from front to back, skipping the tables.
    flat = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert np.frombuffer(flat, "<u4").tolist() == [i for _, ids in documents for i in ids]
    broken = bytearray(data)
    broken[40] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.Reader(io.BytesIO(bytes(broken)), len(data)).documents())
    with pytest.raises(ValueError):
        token_files.Reader(io.BytesIO(data[:-1]), len(data) - 1)
    nothing = written([])
    assert list(token_files.Reader(io.BytesIO(nothing), len(nothing)).documents()) == []


def test_round_trip(spark, odd):
    rows = [tuple(r) for r in token_files.round_trip(odd).collect()]
    plain = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    want, at = [], 0
    for doc_id, text in [(None, "no id"), *((i, t) for i, t in enumerate(ODD) for _ in range(2 if i == 5 else 1))]:
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(rows, key=str) == sorted(want, key=str)
    assert token_files.round_trip(odd.where("false")).count() == 0
    files = token_files.write_files(odd, token_files.fresh_folder(odd))
    assert {r.doc_id for r in token_files.read_files(files, [3, 17]).collect()} == {3, 17}
