"""Line dedup: windows of three lines that occur again, in any document, lose their later occurrences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 3


def _trimmed(line: Column) -> Column:
    return F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def dedup_lines(docs: DataFrame, width: int = WIDTH, counts: bool = True) -> DataFrame:
    """All rows and columns of ``docs``, with later occurrences of repeated windows taken out of ``text``.

    A window is ``width`` consecutive lines that are not blank, compared without white space at their ends. Its first
    occurrence, by doc_id (NULL first), text hash and place, stays; of every later one all lines go, except lines that
    belong to that first occurrence itself, where the two overlap in one document. Covered places of
    overlapping windows are merged. Blank lines stay. Added columns: ``n_lines`` (not blank), ``n_removed``.

    NULL text stays NULL, with 0 lines. Documents of fewer lines than ``width`` have no window and stay as they are.
    Repeated rows (same doc_id and text) count as one document and all get the same text. Rows of one doc_id with
    different texts are different documents. Input columns named ``n_lines`` or ``n_removed`` are replaced; without
    ``counts`` nothing is added, and they stay.

    Windows travel as 64-bit hashes; the first occurrence is a grouped minimum, partial before the shuffle, so a window
    that everyone shares is small. Texts are shuffled once, to meet the places to remove.
    """
    rest = [c for c in docs.columns if not counts or c not in ("n_lines", "n_removed")]
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.col("doc_id").isNotNull().alias("has"),
        F.xxhash64("text").alias("th"),
    )
    lines = F.transform(F.split("row.text", "\n", -1), lambda x, i: F.struct(i.alias("i"), _trimmed(x).alias("x")))
    held = F.filter(lines, lambda x: x["x"] != "")
    hashes = F.transform(held, lambda x: F.xxhash64(x["x"]))
    at = lambda i: F.struct(i.alias("p"), F.xxhash64(*[F.get("lh", i + k) for k in range(width)]).alias("h"))
    keyed = base.select("has", "id", "th", hashes.alias("lh")).where(F.size("lh") >= width)
    windows = keyed.select(
        "has", "id", "th", F.inline(F.transform(F.sequence(F.lit(0), F.size("lh") - width), at)).alias("p", "h")
    )
    spot = F.struct("has", "id", "th", "p")
    first = windows.groupBy("h").agg(F.min(spot).alias("a"), F.max(spot).alias("z")).where("a != z")
    later = windows.join(first.select("h", "a"), "h").where(spot != F.col("a"))
    same = (F.col("a.has") == F.col("has")) & (F.col("a.id") == F.col("id")) & (F.col("a.th") == F.col("th"))
    begin = F.when(same, F.greatest("p", F.col("a.p") + width)).otherwise(F.col("p"))
    spans = later.select("has", "id", "th", begin.alias("b"), (F.col("p") + width - 1).alias("e"))
    gone = spans.where("b <= e").groupBy("has", "id", "th").agg(F.collect_set(F.struct("b", "e")).alias("spans"))
    out = base.join(gone, ["has", "id", "th"], "left").withColumn("held", F.transform(held, lambda x: x["i"]))
    out = out.withColumn("covered", F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["b"], s["e"])))))
    out = out.withColumn("drop", F.transform("covered", lambda k: F.get("held", k)))
    out = out.withColumn("all", F.split("row.text", "\n", -1))
    keep = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), F.col("drop"))
    left = F.array_join(F.transform(keep, lambda i: F.get("all", i)), "\n")
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(left)
    same_columns = [text.alias("text") if c == "text" else F.col(f"row.`{c}`") for c in rest]
    if not counts:
        return out.select(*same_columns)
    return out.select(
        *same_columns,
        F.greatest(F.size("held"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col("spans").isNotNull(), F.size("drop")), F.lit(0)).cast("long").alias("n_removed"),
    )


def op9_line_dedup(docs: DataFrame) -> DataFrame:
    """Per document: lines, lines removed, and the digest of what is left (NULL text counts as empty)."""
    out = dedup_lines(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text"), 256).alias("clean_sha256"))


# For tables in which doc_id is unique.
_BLANK = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"
DOCS_CTE = f"""
l as (select doc_id, i, string_split(t, chr(10))[i] l from
      (select doc_id, coalesce(text, '') t, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) i from docs)),
nb as (select doc_id, i, x, row_number() over (partition by doc_id order by i) p from
       (select doc_id, i, regexp_replace(l, '{_BLANK}', '', 'g') x from l) where x <> ''),
win as (select doc_id, p, x || chr(10) || lead(x, 1) over w || chr(10) || lead(x, 2) over w h from nb
        window w as (partition by doc_id order by p)),
placed as (select *, row_number() over (partition by h order by doc_id, p) n,
           first_value(doc_id) over (partition by h order by doc_id, p) fd,
           first_value(p) over (partition by h order by doc_id, p) fp from win where h is not null),
gone as (select distinct doc_id, unnest(range(case when fd = doc_id then greatest(p, fp + 3) else p end, p + 3)) p
         from placed where n > 1),
dropped as (select doc_id, i from gone join nb using (doc_id, p)),
cleaned as (select doc_id, string_agg(l, chr(10) order by i) t from l anti join dropped using (doc_id, i) group by doc_id)
"""
SQL = f"""
with docs as (select doc_id, text from documents), {DOCS_CTE}
select d.doc_id, coalesce(n.n, 0) n_lines, coalesce(g.n, 0) n_removed, sha256(coalesce(t, '')) clean_sha256
from docs d left join cleaned using (doc_id) left join (select doc_id, count(*) n from nb group by doc_id) n using (doc_id)
left join (select doc_id, count(*) n from dropped group by doc_id) g using (doc_id)
"""
