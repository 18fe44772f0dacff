"""Native operators, line dedup and BPE against brute force, on odd rows and empty tables."""

import hashlib
import itertools
import random
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from txflow.llm import bpe, imatch, licenses, lines, quality

from .conftest import ODD, POEM, frame


def test_quality_base_columns(spark, odd, none):
    text = "a b c d e f g h # x\na b c d e f g h # y\n\na b c d e f g h # y\n" + " ".join(map(str, range(30)))
    got = {r.doc_id: r for r in quality.clean_lines(frame(spark, [*ODD, (99, text)])).collect() if r.doc_id is not None}
    r = got[99]
    assert (r.n_symbols, r.n_dup_lines) == (3, 1)
    words = regex.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {p for i, w in enumerate(windows) if counts[w] > 1 for p in range(i, i + 8)}
    assert (r.n_words, r.n_repeat_words, r.word_chars) == (len(words), len(covered), sum(map(len, words)))
    assert all(not got[k].kept for k in (1, 2, 3, 8, 10))
    assert got[4].n_repeat_words == 30_000 and got[4].base_failed
    assert quality.clean_lines(odd).count() == len(ODD)
    assert quality.clean_lines(none).count() == 0


@pytest.mark.parametrize(
    ("line", "fails"),
    [
        ("Home | News | Sport | About", True),
        ("A plain sentence, with some words in it.", False),
        ("THIS IS SHOUTED AT THE READER ALL ALONG", True),
        ("word### word*** word$$$ word", True),
        ("Buy!! now!! cheap!!", True),
        ("We use a cookie policy.", True),
        ("---", True),
        ("ten words or more in a line without any mark at all", True),
        ("NASA said so, and the report of it was long enough.", False),
    ],
)
def test_line_rules(spark, line, fails):
    assert spark.range(1).select(quality.line_fails(F.lit(line))).first()[0] is fails


def test_licenses(spark, odd, none):
    got = {r.doc_id: r for r in licenses.scan(odd).collect() if r.doc_id is not None}
    assert (got[-5].licenses, got[-5].n_matches, got[-5].best_dice) == ("MIT,all-rights-reserved", 2, 1.0)
    assert got[1].licenses == "" and got[1].best_passage is None
    assert licenses.scan(odd).count() == len(ODD)
    assert licenses.scan(none).count() == 0


def test_license_bounds_lose_no_match():
    for n in range(1, 120):
        lo, hi = licenses.size_bounds(n, 0.8)
        for m in range(1, 260):
            reachable = 2 * min(n, m) / (n + m) >= 0.8
            assert not reachable or lo <= m <= hi


def test_full_license_in_paragraphs(spark):
    body = dict((n, t) for n, t in licenses.TEMPLATES if len(t) > 600)["MIT"]
    words = body.split()
    wrapped = "\n".join(" ".join(words[i : i + 11]) for i in range(0, len(words), 11))
    row = licenses.scan(frame(spark, [(1, f"Some code.\n\n{wrapped}\n\nMore of it.")])).first()
    assert row.licenses == "MIT" and row.best_dice == 1.0


CODE = "\n".join(f"    value_{k} = compute(alpha_{k}, beta_{k}) + offset_{k}" for k in range(60))


def test_license_in_three_paragraphs_with_code(spark):
    body = dict((n, t) for n, t in licenses.TEMPLATES if len(t) > 600)["MIT"]
    parts = body.replace("conditions: The", "conditions:\n\nThe").replace("Software. THE", "Software.\n\nTHE")
    assert parts.count("\n\n") == 2
    row = licenses.scan(frame(spark, [(1, f"{parts}\n\n{CODE}")])).first()
    assert (row.licenses, row.n_matches, row.best_dice) == ("MIT", 1, 1.0)


def test_notice_inside_a_line(spark):
    rows = [
        (1, "This is a small tool of mine, and it is licensed under the MIT License. as you may have read elsewhere by now."),
        (2, "This is a small tool of mine, and it is sold under the terms that you may have read elsewhere by now."),
        (3, "Licensed under the MIT License.\nIt was licensed under the MIT License. from the start, so they told us."),
        (4, "We read: all rights reserved. And that it is licensed under CC BY 4.0. as a whole, which cannot be so."),
    ]
    got = {r.doc_id: (r.licenses, r.n_matches) for r in licenses.scan(frame(spark, rows)).collect()}
    assert got == {1: ("MIT", 1), 2: ("", 0), 3: ("MIT", 1), 4: ("CC-BY-4.0,all-rights-reserved", 2)}


def brute_lines(rows):
    """rows: (doc_id, text), distinct; the cleaned texts."""
    split = {i: t.split("\n") for i, t in rows}
    held = {i: [k for k, x in enumerate(s) if x.strip(" \t\n\x0b\x0c\r")] for i, s in split.items()}
    first, gone = {}, {i: set() for i in split}
    for i in sorted(split):
        bare = [split[i][k].strip(" \t\n\x0b\x0c\r") for k in held[i]]
        for p in range(len(bare) - 2):
            w = tuple(bare[p : p + 3])
            if w in first:
                j, q = first[w]
                gone[i] |= {k for k in range(p, p + 3) if j != i or k >= q + 3}
            else:
                first[w] = (i, p)
    return {i: "\n".join(x for k, x in enumerate(s) if k not in {held[i][g] for g in gone[i]}) for i, s in split.items()}


def test_line_dedup_is_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, "\n".join(rng.choice(["a", "b ", "c", "", " d"]) for _ in range(rng.randrange(12)))) for i in range(60)]
    got = {r.doc_id: r.text for r in lines.dedup_lines(frame(spark, rows)).collect()}
    assert got == brute_lines(rows)


def test_line_dedup_keeps_rows_and_columns(odd, none):
    out = lines.dedup_lines(odd)
    got = out.collect()
    assert out.columns == [*(c for c in odd.columns if c not in ("n_lines", "n_removed")), "n_lines", "n_removed"] and len(got) == len(ODD)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[6][0].text == POEM and by[1][0].text is None
    assert sorted(r.text for r in by[7]) == sorted(["", "", ODD[10][1]])  # both copies of the repeated row
    assert by[9_000_000_000_000_000_000][0].text == "an extra line."
    assert lines.dedup_lines(none).count() == 0


@pytest.fixture(scope="module")
def coder():
    return bpe.WordBpe(bpe.public_path())


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(bpe.public_path())


def ids(coder, text):
    return [i for part in coder.encode(text) for i in part]


def test_bpe_is_the_library(coder, library, texts):
    for text in [*texts.values(), *(t for _, t in ODD if t is not None)]:
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(coder, text) == want
        assert "".join(coder.decode(coder.encode(text))) == library.decode(want, skip_special_tokens=False)


def test_bpe_fuzz(coder, library):
    rng = random.Random(1)
    parts = ["a", "th", "ing", " ", "\n", "é", "é", "Σ", "ΑΣ", "İ", "中", "1", "٣", "'s", "'ll", "!", "##", "\U0001f600"]
    parts += ["\x00", "\x1c", "\x1f", "\x85", "​", "﻿", "　", "<|endoftext|>", "<|", "ſ", "K", "²", "_"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(40)))
        assert ids(coder, text) == library.encode(text, add_special_tokens=False).ids, text


def test_bpe_streams_long_pieces(coder, library):
    rng = random.Random(2)
    long = ["".join(rng.choice("etaonishrdlu") for _ in range(n)) for n in (65, 300, 3000)] + ["a" * 4000, "the" * 900, "é" * 500]
    for piece in long:
        assert list(coder.piece(piece)) == library.encode(piece, add_special_tokens=False).ids


def test_stream_emits_before_the_piece_ends_and_keeps_little(coder):
    taken, merges = 0, coder.merges
    assert merges.proper and merges.longest < merges.lookahead < 1000

    def symbols():
        nonlocal taken
        for block in ["internationalisation"] * 500:
            taken += len(block)
            yield block

    next(merges.stream(symbols()))
    assert taken <= merges.lookahead + merges.longest + len("internationalisation")


def test_stream_tries_no_token_over_the_edge(library):
    """Lengths longer than the symbols read are not looked up, and a short piece's path is walked once, at its end."""
    coder = bpe.WordBpe(bpe.public_path())
    looked, walked, path = [], [], bpe.Merges._path

    class Spelled(dict):
        def get(self, key, default=None):
            looked.append(key)
            return super().get(key, default)

    coder.merges.spelled = Spelled(coder.merges.spelled)
    coder.merges._path = lambda *a: walked.append(1) or path(*a)
    for piece in ("internationalisation", "counterrevolutionaries", "the", "é" * 40):
        assert list(coder.piece(piece)) == library.encode(piece, add_special_tokens=False).ids
    assert looked and not any(bpe.NO_SYMBOL in key for key in looked) and len(walked) == 4


def test_word_caches_stay_bounded_and_exact(library, monkeypatch):
    """A worker's memory for words stays within two generations of the bound, whatever the vocabulary of its texts."""
    monkeypatch.setattr(bpe, "WORDS", 50)
    coder, rng = bpe.WordBpe(bpe.public_path()), random.Random(3)
    text = " ".join("".join(rng.choice("etaonishrdlu") for _ in range(rng.randrange(1, 9))) for _ in range(3000))
    for _ in range(2):
        assert ids(coder, text) == library.encode(text, add_special_tokens=False).ids
    assert len(coder.known) + len(coder.past) <= 100 and len(coder.pieces) + len(coder.old_pieces) <= 100


def test_all_tokens_come_from_the_transducer(texts):
    coder, streamed, whole = bpe.WordBpe(bpe.public_path()), [], bpe.Merges.stream
    coder.merges.stream = lambda blocks: [streamed.append(t) or t for t in whole(coder.merges, blocks)]
    got = {t for text in texts.values() for t in ids(coder, text)}
    pieces = {m[0] for text in texts.values() for m in coder.cut.finditer(coder.normal(text))}
    assert got and got == set(streamed) and len(streamed) >= len(pieces) > 1000


def random_merges(rng, alphabet, n):
    """A proper list: each pair of known tokens makes a new token, after its parts."""
    letters = {k: x for k, x in enumerate(alphabet)}
    spell, pairs = dict(letters), {}
    while len(pairs) < n:
        a, b = rng.choice(list(spell)), rng.choice(list(spell))
        if spell[a] + spell[b] not in spell.values():
            pairs[a, b] = (len(pairs), len(spell))
            spell[len(spell)] = spell[a] + spell[b]
    return bpe.Merges(pairs, {t: len(x) for t, x in spell.items()}, letters), spell


@pytest.mark.parametrize("seed", range(40))
def test_lookahead_is_sufficient_for_any_merge_list(seed):
    """Tokens that end a lookahead before the last symbol stay under every continuation; the stream is the plain merge."""
    rng = random.Random(seed)
    merges, spell = random_merges(rng, "ab" if seed % 2 else "abc", rng.randrange(1, 14))
    number = {x: t for t, x in spell.items()}
    for _ in range(60):
        text = "".join(rng.choice("ab" if seed % 2 else "abc") for _ in range(rng.randrange(1, 60)))
        whole = merges.merge([number[c] for c in text])
        assert list(merges.stream(text)) == list(merges.stream([text])) == whole
        ends = list(itertools.accumulate(len(spell[t]) for t in whole))
        for cut in range(1, len(text)):
            short = merges.merge([number[c] for c in text[:cut]])
            places = itertools.accumulate(len(spell[t]) for t in short)
            stable = [t for t, place in zip(short, places) if place <= cut - merges.lookahead]
            assert whole[: len(stable)] == stable and all(x == y for x, y in zip(ends, itertools.accumulate(len(spell[t]) for t in stable)))


def test_list_with_two_ways_to_a_token_gets_the_general_bound():
    letters = {0: "a", 1: "b", 2: "c"}
    merges = bpe.Merges({(0, 1): (0, 3), (1, 2): (1, 4), (3, 2): (2, 5), (0, 4): (3, 5)}, {0: 1, 1: 1, 2: 1, 3: 2, 4: 2, 5: 3}, letters)
    assert not merges.proper and merges.lookahead == 4 * 3
    assert list(merges.stream("abcabca" * 30)) == merges.merge([ord(c) - ord("a") for c in "abcabca" * 30])


def test_whole_ids_are_given_too(odd, library):
    for row in bpe.encode_tokens(odd, bpe.public_path()).where("doc_id is not null").collect():
        wanted = [library.encode(t or "", add_special_tokens=False).ids for i, t in ODD if i == row.doc_id]
        assert row.ids in wanted


def test_byte_decoder_is_incremental(coder):
    text = "it is naïve 中文"
    runs = [[i] for i in ids(coder, text)]  # a token a time: characters are split between runs
    assert "".join(coder.decode_bytes(runs)) == "it is naïve 中 文 ".replace("中 文", "中文")


def test_encode_decode_rows(odd, none, library):
    got = bpe.encode_decode(odd, bpe.public_path()).collect()
    assert len(got) == len(ODD)
    want = Counter()
    for i, t in ODD:
        tokens = library.encode(t or "", add_special_tokens=False).ids
        digest = hashlib.sha256(" ".join(map(str, tokens)).encode()).hexdigest()
        plain = hashlib.sha256(library.decode(tokens, skip_special_tokens=False).encode()).hexdigest()
        want[i, len(tokens), digest, plain] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert bpe.encode_decode(none, bpe.public_path()).count() == 0


def test_imatch_edits(spark, docs, texts):
    got = {r.doc_id: r for r in imatch.compare_edited(docs).collect()}
    order = sorted(texts)
    for k, i in enumerate(order):
        own, following = texts[i], texts[order[(k + 1) % len(order)]]
        n = len(own) // 4
        edited = own[: len(own) - n] + following[:n]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
    same = {}
    for i in order:
        same.setdefault(texts[i], set()).add(got[i].fingerprint)
    assert all(len(x) == 1 for x in same.values())
    nearer = sum(got[i].near_edited > got[i].near_next for i in order)
    assert nearer >= 0.95 * len(order)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())


def test_imatch_odd_rows(odd, none, spark):
    got = imatch.compare_edited(odd).collect()
    assert len(got) == len(ODD) and sum(r.doc_id == 7 for r in got) == 3 and sum(r.doc_id is None for r in got) == 2
    prints = {(r.doc_id, r.n_chars): r.fingerprint for r in got}
    assert prints[1, 0] == prints[2, 0] and prints[6, len(POEM)] == prints[7, len(POEM)]
    assert prints[3, 8] != prints[2, 0]
    assert imatch.compare_edited(none).count() == 0
    alone = imatch.compare_edited(frame(spark, [(1, "abc def ghi jkl")])).first()
    assert alone.near_next == 1.0


def test_imatch_band_is_exact(spark):
    rows = [(i, "common " + " ".join(f"t{k}" for k in range(20) if i % (k + 2) == 0)) for i in range(100)]
    lexicon = imatch.Lexicon(lowest=0.05, highest=0.3)
    inside = {r.term for r in imatch.band(frame(spark, rows), lexicon).collect()}
    df = Counter(w for _, t in rows for w in set(t.split()))
    hashes = {w: spark.range(1).select(F.xxhash64(F.lit(w))).first()[0] for w in df}
    assert inside == {hashes[w] for w, n in df.items() if 5 <= n <= 30}
