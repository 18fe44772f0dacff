"""Models, components and archives against brute force, on odd rows and empty tables."""

import gzip
import hashlib
import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from txflow.llm import bpe, lines, lm, mixing, simhash, toxicity, warc
from txflow.llm.components import connected
from txflow.llm.linear import Features, Rows, Scorer, fit_logistic

from .conftest import ODD, SF, frame

SMALL = lm.Shape(words=50, classes=7, width=8, noise=8, batch=64)


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(45)] + [(k, k + 1) for k in range(100, 140)] + [(5, 5)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    want = roots({n for x in links for n in x}, links)
    assert got == {n: want[n] for a, b in links if a != b for n in (a, b)}
    assert connected(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def brute_components(prints):
    ids = sorted(prints)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 4]
    return roots(ids, links)


@pytest.mark.parametrize("hot", [2000, 1])
def test_near_duplicates_are_brute_force(docs, texts, hot):
    got = {r.doc_id: r for r in simhash.near_duplicates(docs, hot=hot).collect()}
    prints = {i: simhash.fingerprint(t.encode()) for i, t in texts.items()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == brute_components(prints)


def test_fingerprint_by_hand():
    import xxhash

    words = "The QUICK brown fox the quick brown fox jumps É".split()
    low = [w.translate({k: k + 32 for k in range(65, 91)}) for w in words]
    hs = [xxhash.xxh64_intdigest(" ".join(low[i : i + 4]), 42) for i in range(len(low) - 3)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    assert simhash.fingerprint(" ".join(words).encode()) == want
    assert simhash.fingerprint(b"Two  Words") == xxhash.xxh64_intdigest("two words", 42)


def test_close_fingerprints_in_a_hot_bucket(spark):
    rng = random.Random(4)
    near = {0}
    while len(near) < 300:  # one dense heap of fingerprints
        near.add(rng.choice(sorted(near)) ^ sum(1 << b for b in rng.sample(range(40), rng.randrange(1, 8))))
    prints = spark.createDataFrame([(x,) for x in near], "fp long")
    want = brute_components({x: x for x in near})
    for hot in (1, 20, 10_000):
        got = [(r.a, r.b) for r in simhash.links(prints, len(near), hot=hot).collect()]
        assert all((a ^ b).bit_count() <= 4 for a, b in got)
        assert roots(near, got) == want


def test_masks_share_a_block():
    for n in (10, 10**6, 10**9):
        masks = simhash.block_masks(n)
        for _ in range(200):
            x = sum(1 << b for b in random.sample(range(64), 4))
            assert any(x & m == 0 for m in masks)


def test_simhash_odd_rows(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    zero = {r.component_id for r in got if r.fingerprint == "0" * 16}
    assert zero == {1}  # a NULL doc_id does not name it
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "")[:2] for r in kept.collect()) == sorted(
        {(r.component_id is None, r.component_id or 0) for r in got if r.component_id != 7} | {(False, 7)}
    )
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_lm_counts_and_probabilities(spark, docs, texts):
    tokens = {i: t.encode().lower().split() for i, t in texts.items()}
    train = [i for i in texts if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = Counter(w for i in train for w in tokens[i])
    counts[None] = len(train)
    n, v = sum(counts.values()), len(counts)
    base = lambda i: sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*tokens[i], None])
    got = {r.doc_id: r for r in lm.score(docs).collect()}
    for i, r in got.items():
        assert r.base_score == pytest.approx(base(i), abs=1e-6)
        assert (r.n_tokens, r.train_tokens, r.held_out) == (len(tokens[i]) + 1, n, i not in train)
        assert r.n_known == sum(counts[w] > 0 for w in [*tokens[i], None])
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_is_normalised(spark):
    rows = lm._prepared(frame(spark, [(i, f"a b c{i % 9} d{i % 4}") for i in range(60)]))
    shape = lm.Shape(words=3, classes=4, width=4, noise=4, batch=16)
    counts = lm.count_words(rows, shape)
    v = lm.vocabulary(rows, counts, shape)
    scores = lm.tables(spark, lm.train(rows, v))
    n = v.shape.outcomes
    for a in range(n + 1):
        p = 10 ** scores.log10(np.full(n, a), np.full(n, a // 2), np.arange(n))
        assert p.sum() == pytest.approx(1, abs=1e-4)
    assert (v.tokens, v.distinct) == (sum(r.c for r in counts.collect()) + v.documents, counts.count() + 1)


def test_lm_learns_order(spark):
    rows = [(i, "a b " * 40 if i % 2 else "c d " * 40) for i in range(120)]
    got = lm.score(frame(spark, rows), lm.Shape(words=4, classes=3, width=8, noise=8, batch=256)).where("held_out").collect()
    assert all(r.score > r.base_score + 5 for r in got) and got


def test_lm_does_not_depend_on_partitions(spark, docs):
    """The same scores for any layout, and a held-out gain over the base that does not fade with more tasks."""
    scores, gains = [], []
    for parts in (1, 8, 32):
        got = {r.doc_id: r for r in lm.score(docs.repartition(parts)).collect()}
        scores.append(np.array([got[i].score for i in sorted(got)]))
        held = [r for r in got.values() if r.held_out]
        gains.append(sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held))
    assert np.allclose(scores[0], scores[1], rtol=1e-3) and np.allclose(scores[0], scores[2], rtol=1e-3)
    assert min(gains) > 0.02 and max(gains) - min(gains) < 1e-3


def test_lm_shards_are_averaged(spark, docs):
    """Many small shards still learn."""
    got = lm.score(docs, lm.Shape(shard=2000)).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got.s > got.b


def test_lm_odd_rows(spark, odd, none):
    got = lm.score(odd, SMALL).collect()
    assert len(got) == len(ODD) and {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert lm.score(none, SMALL).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    alone = lm.score(frame(spark, [(held, "never seen")]), SMALL).first()
    assert (alone.train_tokens, alone.n_known) == (0, 0) and abs(alone.base_score) < 1e-9


def toxic_rows(n, seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeioust") for _ in range(5))
    rows, marks = [], []
    for i in range(n):
        words = [word() for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            words[5:8] = [rng.choice(["vileword", "nastyword"]) for _ in range(3)]
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(bad)))
    return rows, marks


def test_toxicity_on_rows_it_has_not_seen(spark):
    rows, marks = toxic_rows(400)
    table, known = frame(spark, rows), spark.createDataFrame(marks[:300], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.op10_toxicity(table, known).collect()}
    assert all(got[i].toxic == bool(t) for i, _, t in marks)
    chain = toxicity.learn(table, toxicity.marks(known))
    left = toxicity.without_toxic(table, chain)
    assert left.columns == table.columns and {r.doc_id for r in left.collect()} == {i for i, _, t in marks if not t}


def test_later_links_of_the_chain_see_earlier_probabilities():
    rng = np.random.default_rng(1)
    n = 400
    a = rng.integers(0, 2, n)
    rows = toxicity.Rows.of([(np.array([1 + x, 5 + k % 3]), np.ones(2)) for k, x in enumerate(a)], 16)
    chain = toxicity.fit_chain(np.stack([a, a], 1).astype(float), rows, ("first", "second"), toxicity.Fit(bits=4, least=1))
    assert chain.earlier[0].shape == (0,) and chain.earlier[1].shape == (1,) and chain.earlier[1][0] > 0
    p = chain.probabilities(np.zeros((2, 2)))
    assert p.shape == (2, 2)


def test_words_have_all_four_prefixes():
    f = Features(18)
    words = ["wonderful", "wonde", "(Wonder)!?", "LOUD", "--", "*", "İstanbul", ""]
    one = lambda kind, name: f.hashed(kind, [name])[0]
    firsts = lambda bare: [one(f"first{n}", bare[:n]) if len(bare) > n else f.size for n in (4, 5, 6, 7)]
    expected = {
        "wonderful": [one("word", "wonderful"), *firsts("wonderful"), f.size, f.size],
        "wonde": [one("word", "wonde"), *firsts("wonde"), f.size, f.size],
        "(Wonder)!?": [one("word", "wonder"), *firsts("wonder"), one("marks", "!?"), f.size],
        "LOUD": [one("word", "loud"), *firsts("loud"), f.size, one("capitals", "")],
        "--": [one("sign", "--"), *[f.size] * 6],
        "*": [one("sign", "*"), *[f.size] * 6],
    }
    got = dict(zip(words, f.of_words(words).tolist(), strict=True))
    assert all(got[w] == row for w, row in expected.items())
    assert got["wonde"][2:5] == [f.size] * 3


def test_scores_are_products_of_the_features_of_texts():
    draw = random.Random(4)
    texts = ["", "one", "One ONE one!! -- *", " ".join("".join(draw.choice("abcdE.!") for _ in range(draw.randrange(1, 11))) for _ in range(3000))]
    f, weights = Features(12), np.random.default_rng(0).standard_normal((1 << 12, 3))
    got, n = Scorer(f, weights).of_texts(texts)
    for text, row, k in zip(texts, got, n, strict=True):
        index, weight = f.of_text(text)
        assert (np.diff(index) > 0).all() and k == len(text.split())
        assert np.allclose(row, weight @ weights[index])


def test_blocks_of_rows_are_one_matrix():
    """All sums over sparse rows against a dense matrix, with empty rows and more rows than a block."""
    rng = np.random.default_rng(5)
    dense = rng.random((1300, 40)) * (rng.random((1300, 40)) < 0.1)
    dense[[0, 600, 1299]] = 0
    rows = Rows.of([(np.flatnonzero(r), r[np.flatnonzero(r)]) for r in dense], 40)
    v, x = rng.standard_normal(40), rng.standard_normal(1300)
    assert np.allclose(rows.times(v), dense @ v) and np.allclose(rows.gathered(x), dense.T @ x)
    assert np.allclose(rows.squares(v), np.square(dense * v).sum(1)) and np.allclose(rows.counted(x), (dense > 0).T @ x)
    some = rng.random(40) < 0.5
    assert np.allclose(rows.only(some).times(v), dense @ (v * some))
    y = (dense[:, 3] > 0).astype(float)
    used = rng.random(1300) < 0.7
    alone = Rows.of([(np.flatnonzero(r), r[np.flatnonzero(r)]) for r in dense[used]], 40)
    none = np.zeros((1300, 0))
    assert np.allclose(fit_logistic(rows, none, y, used=used), fit_logistic(alone, none[used], y[used]))


def test_toxicity_odd_rows(odd, none, labels, no_labels):
    assert toxicity.op10_toxicity(odd, labels).count() == len(ODD)
    got = toxicity.op10_toxicity(odd, no_labels).collect()
    assert len(got) == len(ODD) and not any(r.toxic for r in got) and {r.p_toxic for r in got} == {0.5}
    assert toxicity.op10_toxicity(none, labels).count() == 0


def brute_rates(p, t, goal, steps=60_000):
    """Plain projected gradient in the metric of tokens, with a small constant step."""
    x = np.ones(len(t))
    step = 1 / np.linalg.eigvalsh((p * t[:, None]).T @ p).max()
    for _ in range(steps):
        x = np.maximum(0, x - step * p @ ((x * t) @ p - goal))
    return x


def test_rates_are_brute_force(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3] * 3, 200)
    t = rng.integers(1, 500, 200)
    table = spark.createDataFrame([(i, int(t[i]), *map(float, p[i])) for i in range(200)], "doc_id long, n_tokens long, p_a double, p_b double, p_c double")
    for share in ([0.5, 0.3, 0.2], [0.05, 0.05, 0.9]):
        goal = np.array(share) * t.sum()
        steps = mixing.fit_rates(table, ("a", "b", "c"), goal)
        x = steps.rates(p)
        want = brute_rates(p, t.astype(float), goal)
        assert (x >= 0).all()
        miss = lambda x: np.square((x * t) @ p - goal).sum() / t.sum() ** 2
        assert miss(x) <= miss(want) + 1e-9


def test_mixing_meets_targets_on_documents(docs, spark):
    known = spark.read.parquet(f"{SF}/labels.parquet")
    rows = mixing.op5_mixing(docs, known).collect()
    x, t = np.array([r.rate for r in rows]), np.array([r.n_tokens for r in rows])
    p = np.array([[r[f"p_{d}"] for d in mixing.DOMAINS] for r in rows])
    got = (x * t) @ p / t.sum()
    assert np.allclose(p.sum(1), 1) and (x >= 0).all()
    assert np.abs(got - np.array(mixing.SHARES)).max() < 1e-4


def test_mixing_odd_rows(odd, none, labels, no_labels):
    out = mixing.op5_mixing(odd, no_labels).collect()
    assert len(out) == len(ODD) and len({round(r.p_en, 9) for r in out}) == 1
    assert mixing.op5_mixing(odd, labels).count() == len(ODD)
    assert mixing.op5_mixing(none, no_labels).count() == 0
    up = mixing.mix_up(odd, labels)
    assert up.columns == odd.columns and {r.doc_id for r in up.collect()} == {i for i, _ in ODD}
    assert mixing.mix_up(none, labels).count() == 0


def test_copies_follow_rates():
    rates = np.array([0.0, 1.0, 2.5, 0.3] * 500)
    n = mixing.copies(list(range(2000)), ["t"] * 2000, rates)
    assert (n[0::4] == 0).all() and (n[1::4] == 1).all() and set(n[2::4]) == {2, 3}
    assert abs(n.sum() - rates.sum()) < 60


PAGE = "page_id long, url string, html string, digest string, shard int, kind int, first long"
BIG = "x" * 150
PAGES = [
    (5, "http://b", BIG), (3, "http://a\r\nX: 1", BIG), (3, "http://a2", BIG), (9, None, BIG), (1, "http://é", "y" * 99), (2, "u", "y" * 99),
    (4, "u", None), (6, "u", ""), (None, "u", BIG), (None, "u", BIG), (7, "u", "é" * 60), (8, "u", "é" * 60), (10, "u", "\r\n\r\nWARC/1.1\r\n" * 20),
]
TINY = warc.Layout(shard_bytes=300, file_bytes=700)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "d", 1, 2, 3) for p in PAGES], PAGE)


def files(folder):
    return {p.name: p.read_bytes() for p in Path(folder).glob("*.warc.gz")}


def test_archives(spark, pages, tmp_path):
    got = warc.op7_warc(pages, str(tmp_path / "a"), TINY).collect()
    assert len(got) == len(PAGES)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    kinds = {i: sorted((r.record_type, r.refers_to) for r in rows) for i, rows in by.items()}
    assert kinds[3] == [("response", None), ("revisit", 3)]
    assert kinds[5] == kinds[9] == [("revisit", 3)] and kinds[8] == [("revisit", 7)]
    assert kinds[1] == kinds[2] == kinds[4] == kinds[6] == kinds[10] == [("response", None)]
    assert kinds[None] == [("response", None)] * 2
    for i, _, html in PAGES:
        raw = (html or "").encode()
        assert {(r.payload_bytes, r.payload_digest) for r in by[i]} == {(len(raw), hashlib.sha256(raw).hexdigest())}
    html = {(r.page_id, r.html) for r in warc.read(spark, str(tmp_path / "a")).collect() if r.record_type == "response"}
    assert html == {(i, h or "") for i, _, h in PAGES if i not in (5, 8, 9)}


def test_archives_do_not_depend_on_partitions(spark, pages, tmp_path):
    warc.write(pages, str(tmp_path / "a"), TINY)
    warc.write(pages.repartition(5, "url").coalesce(2), str(tmp_path / "b"), TINY)
    a = files(tmp_path / "a")
    assert a == files(tmp_path / "b") and len(a) > 3
    listed = warc.manifest(spark, str(tmp_path / "a")).collect()
    assert {r.name: r.sha256 for r in listed} == {n: hashlib.sha256(x).hexdigest() for n, x in a.items()}
    assert sum(r.records for r in listed) == len(PAGES)
    first = gzip.decompress(a[listed[0].name]).decode()
    assert first.startswith("WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    ids = [r.page_id for n in sorted(a) for r in warc.read(spark, str(tmp_path / "a")).where(f"file = '{n}'").collect()]
    assert [i for i in ids if i is not None] == sorted(i for i in ids if i is not None)


def test_unpublished_drafts_are_not_read(spark, pages, tmp_path):
    warc.write(pages, str(tmp_path / "a"), TINY)
    (tmp_path / "a" / "_drafts" / "part-000000-00000.warc.gz.left-over").write_bytes(b"broken")
    assert warc.read(spark, str(tmp_path / "a")).count() == len(PAGES)
    name = sorted(files(tmp_path / "a"))[0]
    path = tmp_path / "a" / name
    path.write_bytes(path.read_bytes()[:-9])
    with pytest.raises(Exception, match="ends within|Error|error"):
        warc.read(spark, str(tmp_path / "a")).collect()


def test_no_pages(spark, tmp_path):
    none = spark.createDataFrame([], PAGE)
    assert warc.op7_warc(none, str(tmp_path / "a")).count() == 0


def test_pipeline_stages(spark, docs, texts):
    """Each stage is judged on its own input."""
    steps = dict(corpus_pipeline.STAGES)
    known = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = steps["toxicity"](spark, docs, SF)
    left = {r.doc_id for r in clean.collect()}
    assert clean.columns == docs.columns
    assert sum(known.get(i) == 1 for i in left) <= 1 and sum(known.get(i) == 0 for i in set(texts) - left) == 0
    deduped = steps["line_dedup"](spark, clean, SF)
    now = {r.doc_id: r for r in deduped.collect()}
    assert deduped.columns == docs.columns
    assert {i: r.text for i, r in now.items()} == {**brute(texts, left)}
    assert all(r.n_chars == len(r.text) for r in now.values())
    single = steps["near_dedup"](spark, deduped, SF)
    kept = {r.doc_id for r in single.collect()}
    prints = {i: simhash.fingerprint(r.text.encode()) for i, r in now.items()}
    assert kept == set(brute_components(prints).values()) and single.columns == docs.columns
    mixed = steps["mix"](spark, single, SF)
    assert {r.doc_id for r in mixed.collect()} == kept and mixed.columns == docs.columns
    coded = steps["encode"](spark, mixed, SF).collect()
    assert {r.doc_id for r in coded} == kept and len(coded) == mixed.count()
    coder = bpe.WordBpe(bpe.public_path())
    for r in coded[:20]:
        assert bpe.digests(coder, now[r.doc_id].text)[:3] == (r.n_tokens, r.ids_sha256, r.decoded_sha256)


def brute(texts, left):
    from .test_text import brute_lines

    return brute_lines([(i, texts[i]) for i in left])


def test_pipeline_on_odd_and_empty_tables(spark, odd, none, tmp_path):
    for name, rows in (("odd", odd), ("none", none)):
        folder = str(tmp_path / name)
        rows.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(6, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert (out.count() > 0) == (name == "odd")


def test_line_stage_uses_whole_windows_only(spark):
    rows = [(1, "a\nb"), (2, "a\nb")]
    assert {r.text for r in lines.dedup_lines(frame(spark, rows)).collect()} == {"a\nb"}
