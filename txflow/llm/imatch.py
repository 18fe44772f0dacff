"""I-Match fingerprints: terms of middling document frequency, sorted, hashed over randomised lexicon subsets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import with_rank, written

DIGITS = 3
LEVELS = 3


@dataclass(frozen=True)
class Lexicon:
    """Which terms count, and how the lexicon is cut.

    A term is in the band if its inverse document frequency, N / df, is at least ``1 / highest`` and at most
    ``1 / lowest``. The terms of the band number at most (mean distinct terms of a document) / ``lowest``, whatever the
    size of the corpus; up to ``broadcast_terms`` of them are broadcast, more are joined by a shuffle.

    At level v a random 2^-v of the lexicon is left, and each level is cut into ``subsets`` random subsets. A document
    uses three levels, the first of them so that no more than about 2 * ``terms`` of its terms are left there.
    """

    lowest: float = 1e-3
    highest: float = 0.1
    subsets: int = 32
    terms: int = 120
    broadcast_terms: int = 2_000_000


LEXICON = Lexicon()


def terms(text: Column) -> Column:
    """Distinct hashed terms: runs of letters and digits in lower case, or the text itself where there are none."""
    found = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    hashed = F.array_distinct(F.transform(found, lambda x: F.xxhash64(x)))
    own = F.when(text != "", F.array(F.xxhash64(text))).otherwise(F.array().cast("array<bigint>"))
    return F.transform(F.array(hashed), lambda h: F.when(F.size(h) > 0, h).otherwise(own))[0]


def band(docs: DataFrame, lexicon: Lexicon = LEXICON) -> DataFrame:
    """The terms (hashed, column ``term``) of the frequency band, from all documents; counted partially before the shuffle."""
    n = docs.count()
    counted = docs.select(F.explode(terms(F.coalesce("text", F.lit("")))).alias("term")).groupBy("term").count()
    return counted.where(F.col("count").between(lexicon.lowest * n, max(1.0, lexicon.highest * n))).select("term")


def _low(n: Column, lexicon: Lexicon) -> Column:
    """First level for a document of n terms."""
    ratio = F.greatest(n / F.lit(lexicon.terms), F.lit(1.0))
    return F.least(F.floor(F.log2(ratio)), F.lit(15 - LEVELS)).cast("int")


def _at_level(term: Column, level: Column) -> Column:
    return term.bitwiseAND(F.pow(F.lit(2.0), level).cast("long") - 1) == 0


def _spell(low: Column, kept: Column, lexicon: Lexicon) -> Column:
    """The fingerprint: its first level, then three digits for each subset of each level, 000 where it holds no term."""

    def level(v: int) -> Column:
        left = kept if v == 0 else F.filter(kept, lambda x: _at_level(x, low + v))

        def cut(of: Column) -> Column:
            def one(j: Column) -> Column:
                own = F.sort_array(F.filter(of, lambda x: F.shiftrightunsigned(x, 16).bitwiseAND(F.lit(lexicon.subsets - 1)) == j))
                code = F.pmod(F.xxhash64(own), F.lit(16**DIGITS - 1)) + 1
                return F.when(F.size(own) > 0, F.lpad(F.lower(F.hex(code)), DIGITS, "0")).otherwise("0" * DIGITS)

            return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(lexicon.subsets - 1)).cast("array<bigint>"), one), "")

        return F.transform(F.array(left), cut)[0]

    return F.concat(F.lower(F.hex(low)), *[level(v) for v in range(LEVELS)])


def fingerprint_texts(texts: DataFrame, keys: list[str], names: list[str], lex: DataFrame, lexicon: Lexicon = LEXICON) -> DataFrame:
    """``keys`` and, for each text column in ``names``, its fingerprint under the name of that column.

    ``keys`` must be unique. Terms meet the lexicon one by one, as rows, and are gathered again for their text.
    """
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), terms(F.col(c)).alias("all")) for k, c in enumerate(names)])
    step = texts.select(*keys, F.inline(kinds).alias("kind", "all")).withColumn("low", _low(F.size("all"), lexicon))
    kept = F.filter("all", lambda x: _at_level(x, F.col("low")))
    lex = lex.select("term", F.lit(True).alias("inside"))
    rows = step.select(*keys, "kind", "low", F.explode_outer(kept).alias("term")).join(lex, "term", "left")
    held = rows.groupBy(*keys, "kind", "low").agg(
        F.collect_list(F.when(F.col("inside"), F.col("term"))).alias("band"), F.collect_list(F.when(F.col("inside").isNull(), F.col("term"))).alias("other")
    )
    chosen = F.when(F.size("band") > 0, F.col("band")).otherwise(F.col("other"))
    held = held.select(*keys, "kind", "low", chosen.alias("kept"))
    spelled = held.select(*keys, "kind", _spell(F.col("low"), F.col("kept"), lexicon).alias("fp"))
    wide = [F.max(F.when(F.col("kind") == k, F.col("fp"))).alias(c) for k, c in enumerate(names)]
    return spelled.groupBy(*keys).agg(*wide)


def likeness(a: Column, b: Column, lexicon: Lexicon = LEXICON) -> Column:
    """Equal subsets among those that either fingerprint fills, on their common levels; 1 for equal fingerprints."""
    low = lambda x: F.conv(F.substring(x, 1, 1), 16, 10).cast("int")
    shift = (low(a) - low(b)) * lexicon.subsets
    blank = "0" * DIGITS

    def pair(i: Column) -> Column:
        at = lambda x, k: F.substring(x, 2 + DIGITS * k, F.lit(DIGITS))
        j = i + shift
        x, y = at(a, i), at(b, j)
        inside = (j >= 0) & (j < LEVELS * lexicon.subsets)
        return F.when(inside & ((x != blank) | (y != blank)), (x == y).cast("int"))

    found = F.filter(F.transform(F.sequence(F.lit(0), F.lit(LEVELS * lexicon.subsets - 1)), pair), lambda x: x.isNotNull())
    share = lambda f: F.aggregate(f, F.lit(0), lambda s, x: s + x) / F.greatest(F.size(f), F.lit(1))
    return F.when(a == b, 1.0).otherwise(F.transform(F.array(found), share)[0])


def compare_edited(docs: DataFrame, lexicon: Lexicon = LEXICON) -> DataFrame:
    """Every row's fingerprint beside those of its edited text and of the next document.

    The edited text ends in the beginning of the next document's, in place of its last quarter. Columns: ``doc_id``,
    ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    Documents stand in order of doc_id (NULL first), then text hash; the last is followed by the first, and a single
    document by itself. Rows equal in doc_id and text are one document, with as many equal rows in the result. NULL
    text counts as empty. A text without a term in the band is known by all its terms; one without letters and digits
    by itself as its only term; the empty text by none. Equal texts have equal fingerprints, and likeness 1.

    Whole texts are shuffled once, by document, for both joins; terms are gathered where their text lies.
    """
    base = docs.select(
        F.col("doc_id").isNotNull().alias("has"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.coalesce("text", F.lit("")).alias("t"),
    ).withColumn("th", F.xxhash64("t"))
    key = ["has", "id", "th"]
    ranked, total = with_rank(base.select(*key, F.char_length("t").alias("n")), key)
    prev = ranked.select(*[F.col(k).alias(f"p_{k}") for k in key], F.expr("n div 4").alias("take"), ((F.col("rank") + 1) % max(total, 1)).alias("rank"))
    need = ranked.select(*key, "rank").join(prev, "rank").drop("rank")
    lex = written(band(base.select(F.col("t").alias("text")), lexicon), "lexicon")
    if lex.count() <= lexicon.broadcast_terms:
        lex = F.broadcast(lex)
    whole = base.repartition(*key).groupBy(*key).agg(F.first("t").alias("t"), F.count("*").alias("copies"))
    heads = whole.join(need, key).select(*[F.col(f"p_{k}").alias(k) for k in key], F.expr("left(t, take)").alias("head"))
    n = F.char_length("t")
    edited = whole.join(heads, key).withColumn("e", F.concat(F.expr("left(t, char_length(t) - char_length(t) div 4)"), "head"))
    facts = [n.cast("long").alias("n_chars"), F.sha2("e", 256).alias("edited_sha256"), "copies"]
    texts = edited.select(*key, F.struct(*facts).alias("facts"), "t", "e")
    prints = fingerprint_texts(texts, [*key, "facts"], ["t", "e"], lex, lexicon)
    done = written(prints, "imatch")
    following = ranked.select(*key, "rank").join(done.select(*key, "t"), key).select(
        F.pmod(F.col("rank") - 1, F.lit(max(total, 1))).alias("rank"), F.col("t").alias("next")
    )
    out = done.join(ranked.select(*key, "rank"), key).join(following, "rank")
    return out.select(
        F.when(F.col("has"), F.col("id")).alias("doc_id"),
        "facts.n_chars",
        "facts.edited_sha256",
        F.col("t").alias("fingerprint"),
        F.col("e").alias("edited_fingerprint"),
        likeness(F.col("t"), F.col("e"), lexicon).alias("near_edited"),
        likeness(F.col("t"), F.col("next"), lexicon).alias("near_next"),
        F.explode(F.sequence(F.lit(1), F.col("facts.copies"))).alias("copy"),
    ).drop("copy")
