"""BPE encoding as a streaming transducer with bounded lookahead, and decoding as a byte-to-text state machine.

A piece (the text between pre-tokenizer cuts) is fed symbol by symbol. The tokenization of each prefix is that of a
shorter one and a last token, so what has been read is a tree of places. The merge list is analysed once for its
sufficient lookahead (:meth:`Merges.sufficient_lookahead`): a token that ends so many symbols before the last one read is
the same under any continuation. Such tokens are emitted and forgotten. All pieces take this way; a bounded cache
remembers the ids of short words.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import of_worker

# Fixed values of the tokenizer file's kind: its normalizer and pre-tokenizer, checked against the file when it is read.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMAL = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
BLANK = r"\p{White_Space}"
END = "</w>"
ODD = regex.compile("[\\x1c-\\x1f]")  # white space to str.split() alone
RUN = 4096
CHUNK = 1 << 14
CACHE = 1 << 18
WORDS = 1 << 16  # words and pieces remembered, in each of two generations: their ids cost a worker far more memory
NO_SYMBOL = "\uffff"
HELD = 64  # letters of the longest words and pieces that are remembered


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Merges:
    """A merge list over symbols numbered as in the vocabulary; ``letters`` gives each single symbol a character."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], lengths: dict[int, int], letters: dict[int, str]):
        self.pairs, self.lengths = pairs, lengths
        self.longest = max(lengths.values(), default=1)
        self._ok: dict[tuple[int, int], bool] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.proper = True
        self.spell = {s: (s,) for s in letters}
        spelled = dict(letters)
        self.rank = dict.fromkeys(letters, -1)
        for (a, b), (at, made) in sorted(pairs.items(), key=lambda x: x[1][0]):
            self.proper &= made not in spelled and a in spelled and b in spelled
            self.parts.setdefault(made, (a, b))
            self.rank.setdefault(made, at)
            self.spell.setdefault(made, self.spell[a] + self.spell[b])
            spelled.setdefault(made, spelled[a] + spelled[b])
        # A token whose parts never meet, as their spelling is merged in another way, ends no prefix.
        reached = set(letters)
        for made, (a, b) in self.parts.items():
            if self.proper:
                if a in reached and b in reached and self._apart(a, b, self.rank[made]):
                    reached.add(made)
            elif self.merge([*self.spell[made]]) == [made]:
                reached.add(made)
        self.spelled = {x: t for t, x in spelled.items() if t in reached}
        self.sizes: dict[str, set[int]] = {}  # the four last symbols of longer tokens -> lengths of such tokens
        for x in self.spelled:
            if len(x) > 4:
                self.sizes.setdefault(x[-4:], set()).add(len(x))
        self._endings: dict[str, list[tuple[int, int | None]]] = {}
        self.lookahead = self.sufficient_lookahead()

    def sufficient_lookahead(self) -> int:
        """Symbols before the last one read at which tokens can no longer change.

        Take a text and a continuation of it, and apply the merges in order to both. What they share from the left ends
        at first where the text ends. A merge (a, b) moves that end only if a is the last shared token and b stands after
        it in one of the two alone: by the length of a. From then on both go on with a token that has a as its left part,
        its left part's left part, and so on, so the next merge to move the end is a later one whose right side has a there.
        The most that such a chain of merges can move the end is found in one pass over the list. It needs a list in which
        each token is made by one pair, after both of its parts; any other list gets the general bound, one longest token
        for each merge.
        """
        if not self.proper:
            return max(1, len(self.pairs)) * self.longest
        moved: dict[int, int] = {}  # token -> furthest that a chain gets whose last merge had it on the left
        for (a, b), _ in sorted(self.pairs.items(), key=lambda x: x[1][0]):
            furthest, token = moved.get(b, 0), b
            while token in self.parts:
                token = self.parts[token][0]
                furthest = max(furthest, moved.get(token, 0))
            moved[a] = max(moved.get(a, 0), self.lengths[a] + furthest)
        return max(moved.values(), default=1)

    def merge(self, symbols: list[int]) -> list[int]:
        """Tokens of a few symbols: the pair that stands first in the list is merged first, leftmost first."""
        get = self.pairs.get
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                found = get((symbols[i], symbols[i + 1]))
                if found is not None and (best is None or found < best):
                    best, at = found, i
            if best is None:
                break
            symbols[at : at + 2] = [best[1]]
        return symbols

    def fits(self, a: int, b: int) -> bool:
        """Whether the two tokens stand side by side in the tokenization of their own spelling."""
        known = self._ok.get((a, b))
        if known is None:
            if len(self._ok) >= CACHE:
                self._ok.clear()
            known = self._apart(a, b, len(self.rank)) if self.proper else self.merge([*self.spell[a], *self.spell[b]]) == [a, b]
            self._ok[a, b] = known
        return known

    def _apart(self, a: int, b: int, until: int) -> bool:
        """Whether no merge before ``until`` crosses the border of two tokens; for proper lists.

        From the whole tokens back to single symbols: which two tokens met at the border, and until when each was there.
        Of three equal ones in a row the first two are merged.
        """
        pairs, rank, parts = self.pairs, self.rank, self.parts
        a_until = b_until = until
        while True:
            crossing = pairs.get((a, b))
            if crossing is not None and crossing[0] < a_until and crossing[0] <= b_until:
                return False
            made_a, made_b = rank[a], rank[b]
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                a_until, a = made_a, parts[a][1]
            else:
                b_until, b = made_b, parts[b][0]

    def endings(self, last: str) -> list[tuple[int, int | None]]:
        """Lengths of tokens that may end with the four last symbols, longest first, and the token where these tell it."""
        if len(self._endings) >= CACHE:
            self._endings.clear()
        out = [(n, None) for n in sorted(self.sizes.get(last, ()), reverse=True)]
        out += [(4 - k, self.spelled[last[k:]]) for k in range(4) if last[k:] in self.spelled]
        self._endings[last] = out
        return out

    def stream(self, blocks: Iterable[str]) -> Iterator[int]:
        """Tokens of a piece that comes in blocks, each emitted once the lookahead has passed it.

        Kept: the symbols since the last emitted token, which are no more than the lookahead, a block and a token, and for
        each of their places the last token of the tokenization that ends there.
        """
        spelled, endings, known = self.spelled.get, self._endings.get, self._ok.get
        edge = max(4, self.longest)  # so many characters that stand for no symbol come before the others
        text, token, begin = NO_SYMBOL * edge, [None] * (edge + 1), [0] * (edge + 1)
        for block in blocks:
            first, text = len(text) + 1, text + block
            for end in range(first, len(text) + 1):
                last, room = text[end - 4 : end], end - edge  # no token reaches back into the edge
                for n, found in endings(last) or self.endings(last):
                    if n > room:
                        continue
                    if found is None:
                        found = spelled(text[end - n : end])
                        if found is None:
                            continue
                    left = token[end - n]
                    if left is not None:
                        good = known((left, found))
                        if not (self.fits(left, found) if good is None else good):
                            continue
                    token.append(found)
                    begin.append(end - n)
                    break
            if len(text) - self.lookahead <= edge:  # too short a stretch for any token to be settled
                continue
            stable = [x for x in self._path(edge, token, begin) if x <= len(text) - self.lookahead]
            if stable:
                yield from map(token.__getitem__, stable)
                gone = stable[-1] - edge  # the token before decides what may follow it, so it stays in its place
                text, token, begin = NO_SYMBOL * edge + text[stable[-1] :], token[gone:], [x - gone for x in begin[gone:]]
        yield from map(token.__getitem__, self._path(edge, token, begin))

    @staticmethod
    def _path(edge: int, token: list, begin: list[int]) -> list[int]:
        """The places where tokens end, from the edge to the last place."""
        out, place = [], len(token) - 1
        while place > edge:
            out.append(place)
            place = begin[place]
        return out[::-1]


class WordBpe:
    """Encoder and decoder for a tokenizer file of lower-cased words with an end mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cuts = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        plain = spec["normalizer"]["normalizers"] == NORMAL and cuts[0]["pattern"] == {"Regex": CUT}
        if not plain or model["end_of_word_suffix"] != END or spec["decoder"] is not None:
            raise ValueError("not a tokenizer file of this kind")
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        letters = byte_letters()
        self.inner = [vocab[letters[b]] for b in range(256)]
        self.final = [vocab[letters[b] + END] for b in range(256)]
        lengths = {i: 1 for i in (*self.inner, *self.final)}
        pairs = {}
        for rank, (a, b) in enumerate(tuple(m) if not isinstance(m, str) else m.split(" ") for m in model["merges"]):
            made = vocab[a + b]
            lengths.setdefault(made, lengths[vocab[a]] + lengths[vocab[b]])
            pairs.setdefault((vocab[a], vocab[b]), (rank, made))
        # A byte is the character of its number, the last byte of a piece that of its number and 256.
        self.merges = Merges(pairs, lengths, {s: chr(k) for k, s in enumerate((*self.inner, *self.final))})
        bytes_of = {c: b for b, c in letters.items()}
        self.bytes = {
            i: bytes(bytes_of[c] for c in t.removesuffix(END)) + b" " * t.endswith(END) for t, i in vocab.items()
        } | {i: t.encode() for t, i in self.special.items()}
        self.cut = regex.compile(CUT.replace(r"\s", BLANK))
        self.blank = regex.compile(f"[{BLANK}]+")
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pieces: dict[str, list[int]] = {}
        self.old_pieces: dict[str, list[int]] = {}
        self.known: dict[str, list[int]] = {}
        self.past: dict[str, list[int]] = {}
        self.digits = {i: str(i) for i in self.text}

    def normal(self, text: str) -> str:
        text = self.blank.sub(" ", unicodedata.normalize("NFC", text))
        return text.replace("Σ", "σ").lower()  # each letter by itself: no special form at the end of words

    def piece(self, piece: str) -> Iterator[int]:
        raw, size = piece.encode(), self.merges.lookahead
        symbols = raw[:-1].decode("latin-1") + chr(256 + raw[-1])
        return self.merges.stream(symbols[k : k + size] for k in range(0, len(symbols), size))

    def word(self, word: str) -> list[int] | Iterator[int]:
        """Ids of a word, which no piece leaves; a generator where a piece is longer than the lookahead."""
        pieces = [m[0] for m in self.cut.finditer(self.normal(word))]
        if any(len(p) > self.merges.lookahead for p in pieces):
            return (i for p in pieces for i in self.piece(p))
        out = []
        for p in pieces:
            ids = self.pieces.get(p) or self.old_pieces.get(p)
            if ids is None:
                ids = list(self.piece(p))
            if len(p) <= HELD and p not in self.pieces:
                if len(self.pieces) >= WORDS:
                    self.old_pieces, self.pieces = self.pieces, {}
                self.pieces[p] = ids
            out += ids
        return out

    def encode(self, text: str) -> Iterator[list[int]]:
        """Token ids in runs of bounded length. Words are known from two generations of a bounded cache."""
        out: list[int] = []
        for part in self.split.split(text) if self.split and "<|" in text else (text,):
            if part in self.special:
                out.append(self.special[part])
                continue
            words = self.blank.split(part) if ODD.search(part) else part.split()
            get = self.known.get
            for k in range(0, len(words), RUN):
                for word in words[k : k + RUN]:
                    ids = get(word)
                    if ids is None:
                        ids = self.past.get(word)
                        if ids is None:
                            ids = self.word(word)
                            if not isinstance(ids, list):
                                for token in ids:
                                    out.append(token)
                                    if len(out) >= CHUNK:
                                        yield out
                                        out = []
                                continue
                        if len(word) <= HELD:
                            if len(self.known) >= WORDS:
                                self.past, self.known = self.known, {}
                                get = self.known.get
                            self.known[word] = ids
                    out += ids
                if len(out) >= CHUNK:
                    yield out
                    out = []
        if out:
            yield out

    def decode(self, runs: Iterable[list[int]]) -> Iterator[str]:
        """The library's decoding of this file: token texts, special ones included, joined by one space."""
        text, lead = self.text.__getitem__, ""
        for ids in runs:
            yield lead + " ".join(map(text, ids))
            lead = " "

    def decode_bytes(self, runs: Iterable[list[int]]) -> Iterator[str]:
        """Plain text: bytes of the tokens, a space at each end mark, through an incremental UTF-8 state machine.

        A character that two tokens share is given out once its last byte has come; a broken one becomes U+FFFD.
        """
        machine, of = codecs.getincrementaldecoder("utf-8")("replace"), self.bytes.__getitem__
        for ids in runs:
            yield machine.decode(b"".join(map(of, ids)))
        yield machine.decode(b"", True)


def loaded(path: str) -> WordBpe:
    """The encoder of this Python worker."""
    return of_worker(path, lambda: WordBpe(path))


def public_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizer file of this machine lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def digests(coder: WordBpe, text: str) -> tuple[int, str, str, str]:
    """Number of ids, and SHA-256 of the ids, of the library's decoding and of the plain text, in one pass."""
    ids_sha, decoded_sha, plain_sha = hashlib.sha256(), hashlib.sha256(), hashlib.sha256()
    n, machine = 0, codecs.getincrementaldecoder("utf-8")("replace")
    for ids in coder.encode(text):
        lead = " " if n else ""
        n += len(ids)
        ids_sha.update((lead + " ".join(map(coder.digits.__getitem__, ids))).encode())
        decoded_sha.update((lead + " ".join(map(coder.text.__getitem__, ids))).encode())
        plain_sha.update(machine.decode(b"".join(map(coder.bytes.__getitem__, ids))).encode())
    plain_sha.update(machine.decode(b"", True).encode())
    return n, ids_sha.hexdigest(), decoded_sha.hexdigest(), plain_sha.hexdigest()


OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, plain_sha256 string"


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """One row for each document: count and digest of its ids, digests of both decodings.

    Ids are those of the tokenizer file at ``path``, special strings in a text included. NULL text counts as empty and
    has 0 tokens. Rows are independent, repeated ones get the same result, nothing is shuffled, and a text of any
    length is worked on in runs of bounded length. Only ``doc_id`` and ``text`` are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(path)
        names = [x.split(" ")[0] for x in OUT.split(", ")]
        for batch in batches:
            got = [digests(coder, x or "") for x in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), pa.array([x[0] for x in got], pa.int64())]
            columns += [pa.array([x[k] for x in got], pa.string()) for k in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, OUT)


def encode_tokens(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and the whole array of ids ``ids`` for each document, for writers of training shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(path)
        for batch in batches:
            ids = [[i for part in coder.encode(x or "") for i in part] for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")
