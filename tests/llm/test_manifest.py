"""Packing, whitening and the Merkle manifest against plain versions, on odd rows and empty tables."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txflow.llm import catalog, merkle, packing, whitening

from .conftest import ODD, SF, frame

VECTORS = "vec_id long, embedding array<float>, x string, i string, c string, deviation string, part string, n string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.public_path())


# -- packing -----------------------------------------------------------------


def packed_plainly(rows, tokenizer, length=1024):
    """Pieces of documents that stand in the given order, one row of tokens for all."""
    out, place = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        start = 0
        while start < len(ids):
            sequence, offset = divmod(place + start, length)
            take = min(length - offset, len(ids) - start)
            data = np.array(ids[start : start + take], "<u4").tobytes()
            out.append((doc_id, start, take, zlib.crc32(data), len(ids), sequence, offset))
            start += take
        place += len(ids)
    return out


PIECES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@pytest.mark.parametrize("parts", [1, 7])
def test_packing_equals_plain_version(spark, docs, texts, tokenizer, parts):
    got = packing.op11_packing(docs.repartition(parts)).select(*PIECES).collect()
    assert sorted(map(tuple, got)) == sorted(packed_plainly(sorted(texts.items()), tokenizer))


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_sequences_join_boundary_records(spark, docs, texts, tokenizer, many_partitions):
    small = packing.Packing(length=64)
    got = sorted(packing.sequences(docs, small).collect(), key=lambda r: r.sequence_id)
    stream = [i for _, t in sorted(texts.items()) for i in [*tokenizer.encode(t, add_special_tokens=False).ids, 0]]
    assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in got]).tolist() == stream
    assert [r.sequence_id for r in got] == list(range(len(got)))
    assert all(r.length == 64 for r in got[:-1]) and 0 < got[-1].length <= 64
    for r in got:
        assert [p.offset for p in r.pieces] == np.cumsum([0, *(p.length for p in r.pieces[:-1])]).tolist()
    assert packing.records(docs, small).where("not whole").count() > 4


def test_packing_of_odd_rows(spark, odd, none, tokenizer):
    got = packing.op11_packing(odd).collect()
    want = Counter(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ODD)
    assert Counter(r.doc_tokens for r in got if r.start == 0) == want
    by = sorted((r.sequence_id, r.offset, r.length) for r in got)
    place = 0
    for sequence, offset, length in by:
        assert (sequence, offset) == divmod(place, 1024)
        place += length
    assert place == sum(n * k for n, k in want.items())
    special = next(r for r in got if r.doc_id == 9)
    ids = [*tokenizer.encode(dict(ODD)[9], add_special_tokens=False).ids, 0]
    assert 50256 in ids and special.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert packing.op11_packing(none).count() == 0 and packing.sequences(none).count() == 0


def test_a_repeated_row_is_spread_over_partitions(spark, many_partitions):
    one = frame(spark, [(5, "the same few words again")]).crossJoin(spark.range(20_000).select())
    stored, _ = packing.encoded(one, packing.Packing())
    sizes = [r["count"] for r in stored.groupBy("part").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 10_000


def test_encoder_equals_the_library(tokenizer):
    encoder = packing.Encoder(packing.public_path())
    assert encoder.fast is not None
    draws = np.random.default_rng(3)
    signs = [*" \n\t'!aZ09é中İßµ  \x85\U0001f600<|>", "<|endoftext|>", "'ll", "  ", "word", "\x00", "ſ", "́"]
    for _ in range(300):
        text = "".join(draws.choice(signs, draws.integers(0, 40)))
        assert encoder.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    codes = [c for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    text = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)}" for c in codes]
    for t, e in zip(text, tokenizer.encode_batch(text, add_special_tokens=False), strict=True):
        assert encoder.ids(t).tolist() == e.ids
    encoder.fast = None
    assert encoder.ids("two ways").tolist() == tokenizer.encode("two ways", add_special_tokens=False).ids


def test_files_of_another_kind_take_the_plain_way(tmp_path):
    import json

    told = json.load(open(packing.public_path(), encoding="utf-8"))
    told["normalizer"] = {"type": "Lowercase"}
    path = tmp_path / "lower.json"
    path.write_text(json.dumps(told))
    encoder = packing.Encoder(str(path))
    assert encoder.fast is None and encoder.ids("ABC").tolist() == packing.Encoder(packing.public_path()).ids("abc").tolist()


# -- whitening ---------------------------------------------------------------


def whitened_plainly(x, components=16):
    rows = np.unique(x, axis=0)
    n, sums = len(rows), rows.sum(0)
    c = (rows * n - sums) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    return n, sums, e, ((x * n - sums) / n) @ q / np.sqrt(e), np.trace(c.T @ c / n)


def table_of(got, names):
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = [r[c] for c in names]
    return {k: [v[c] for c in sorted(v)] for k, v in by.items()}


def check_whitening(got, ids, x, components=16):
    n, sums, e, y, trace = whitened_plainly(x, components)
    by = table_of(got, ("whitened", "explained", "deviation", "n", "identity_error"))
    assert set(by) == set(ids)
    mine = np.array([[c[0] for c in by[i]] for i in ids])
    assert mine.shape == y.shape
    assert np.abs(mine * np.sign((mine * y).sum(0)) - y).max() < 1e-9
    for i, row in zip(ids, x, strict=True):
        assert [c[2] for c in by[i]] == [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True))] * len(e)
        assert np.allclose([c[1] for c in by[i]], e / trace, rtol=1e-9) and by[i][0][3] == n and by[i][0][4] < 1e-10


def test_whitening_equals_plain_version(spark):
    got = catalog.op12_whitening(spark, SF)
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.floor(64 * np.array([r.embedding for r in rows], float)).astype(np.int64) + 1_000_000
    check_whitening(got.collect(), [r.vec_id for r in rows], x)


def test_whitening_of_odd_rows(spark):
    draws = np.random.default_rng(5)
    good = np.round(draws.standard_normal((40, 5)) * [9, 7, 5, 3, 2], 1).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(good)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, rows[0][1])]  # copies are fitted once
    x = np.floor(64 * np.array([v for _, v in rows], float)).astype(np.int64) + 1_000_000
    odd = [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0]), (202, [1.0, float("nan"), 1.0, 1.0, 1.0])]
    odd += [(203, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (204, []), (205, [1.0, 2.0]), (206, [float("-inf")] * 5)]
    df = spark.createDataFrame([(i, v, *["7"] * 6) for i, v in [*rows, *odd]], VECTORS)
    for parts in (1, 6):
        check_whitening(whitening.op12_whitening(df.repartition(parts)).collect(), [i for i, _ in rows], x)


@pytest.mark.parametrize("name", ["none", "one", "equal", "nulls"])
def test_whitening_without_deviation_gives_no_rows(spark, name):
    rows = {"none": [], "one": [(1, [1.0, 2.0])], "equal": [(1, [1.0, 2.0])] * 9, "nulls": [(1, None), (2, [None])]}[name]
    df = spark.createDataFrame([(i, v, *["7"] * 6) for i, v in rows], VECTORS)
    got = whitening.op12_whitening(df)
    assert got.count() == 0
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_equal_and_vanishing_singular_values():
    """Repeated singular values need a new direction each; vanishing ones end a chain."""
    draws = np.random.default_rng(1)
    for deviations in ([3, 3, 3, 2, 2, 1], [5, 4, 0, 0, 0, 0], [1, 1, 1, 1, 1, 1], [7, 1e-3, 1e-3, 0, 0, 0]):
        left, _ = np.linalg.qr(draws.standard_normal((50, 6)))
        right, _ = np.linalg.qr(draws.standard_normal((6, 6)))
        x = left @ np.diag(deviations).astype(float) @ right.T
        passes = []

        def product(short, x=x, passes=passes):
            long = x @ short
            passes.append(1)
            return long.T @ long[:, -1], x.T @ long[:, -1]

        basis, b = whitening.bidiagonal(product, 6, 6)
        assert np.allclose(basis.T @ basis, np.eye(6), atol=1e-13)
        assert np.allclose(np.linalg.svd(b)[1], deviations, atol=1e-12) and len(passes) <= 12


def test_many_tasks_are_summed_in_groups(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    x = [[1_000_000 + k, 1_000_000 - 2 * k] for k in range(30)]
    table = spark.createDataFrame([(v,) for v in x], "x array<long>").repartition(9)
    held = whitening.FitList(table, 9, 30, tuple(sum(c) for c in zip(*x, strict=True)))
    got = whitening.summed(held, 2, lambda rows: np.square(rows).sum(0))
    assert np.allclose(got, 30 * np.array(x).var(0), rtol=1e-12)


# -- Merkle manifest ---------------------------------------------------------


def plain_tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([merkle.digest("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def plain_way(tree, i):
    for nodes in tree[:-1]:
        yield i % 3, nodes[i // 3 * 3 : i // 3 * 3 + 3]
        i //= 3


def plain_manifest(rows):
    """Rows (doc_id, source, lang, n_chars, text) by the letter of the contract."""

    def leaf(row, text):
        parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)]
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def lost(row):
        changed = row[4] is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
        return row[4].replace("\n", "") if changed else row[4]

    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append((row[0], leaf(row, row[4]), leaf(row, lost(row))))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    trees = [plain_tree([x for _, x, _ in sources[s]]) for s in names]
    top = plain_tree([t[-1][0] for t in trees])
    for k, (s, tree) in enumerate(zip(names, trees, strict=True)):
        for i, (doc_id, own, found) in enumerate(sources[s]):
            proof = ""
            for at, run in [*plain_way(tree, i), *plain_way(top, k)]:
                proof += "".join(run[:at] + run[at + 1 :])
                found = merkle.digest("".join([*run[:at], found, *run[at + 1 :]]))
            yield doc_id, own, tree[-1][0], top[-1][0], merkle.digest(proof), found, found == top[-1][0]


LEAVES = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize(("levels", "parts"), [(7, 1), (2, 6), (1, 3)])
def test_merkle_equals_plain_version(spark, docs, levels, parts):
    rows = [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]
    got = merkle.op13_merkle(docs.repartition(parts), merkle.Shape(levels=levels)).select(*LEAVES).collect()
    assert sorted(map(tuple, got)) == sorted(plain_manifest(rows))


def test_merkle_of_odd_rows(spark, odd, none):
    by_source = {None: None, 1: "", 2: "é", 4: "z", 6: "\U0001f600", 7: "￿"}
    source = F.create_map(*[x for k, v in by_source.items() if k is not None for x in (F.lit(k).cast("long"), F.lit(v))])
    rows = odd.withColumn("source", source[F.col("doc_id")]).withColumn("n_chars", F.char_length("text").cast("long"))
    plain = [tuple(r) for r in rows.select(*merkle.FIELDS).collect()]
    for levels in (1, 7):
        got = merkle.op13_merkle(rows, merkle.Shape(levels=levels)).select(*LEAVES).collect()
        assert Counter(map(tuple, got)) == Counter(plain_manifest(plain))
    assert merkle.op13_merkle(none).count() == 0
    lone = merkle.op13_merkle(rows.where("doc_id = 2")).first()
    assert lone.leaf == lone.subroot == lone.root == lone.folded_root and lone.verified
    assert lone.proof_sha256 == merkle.digest("")


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 82])
def test_proofs_of_sources_of_any_size(spark, n):
    rows = frame(spark, [(k, f"line {k}\nend") for k in range(n)]).withColumn("source", F.lit("a"))
    rows = rows.withColumn("n_chars", F.lit(1).cast("long"))
    got = merkle.op13_merkle(rows, merkle.Shape(levels=2)).select(*LEAVES).collect()
    assert sorted(map(tuple, got)) == sorted(plain_manifest([tuple(r) for r in rows.select(*merkle.FIELDS).collect()]))
    wrong = {k for k in range(n) if zlib.crc32(str(k).encode()) % 2 == 0}
    assert {r.doc_id for r in got if not r.verified} == wrong
