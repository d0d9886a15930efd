"""Secret scanning with corpus-wide ownership frequency, in DataFrame functions only.

Every text is scanned once per pattern inside the row.  Candidate values are hashed and
counted by distinct repositories and owners over the whole corpus (grouped counts,
combined before each shuffle): a value found under many owners is a widely copied example,
one confined to few looks live.  Base findings always stay; findings of the further
patterns stay only if they look live.  A private key is its whole block: the body is
counted, the span runs from the header to the END line, or over the body if that is missing.

Defined results: null and empty texts have no findings; a null id is kept; rows repeated
with the same id and text get the same findings; a null owner or repository counts as one
of its own; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from abundara.llm.common import cut, fresh, text_digest

_HEADER = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
#: What follows the header: all up to the END line, or without one the lines of the body.  Loops are possessive and bounded: no backtracking, no deep stack.
_CLOSED = r"[^-]*+(?:-{1,4}+[^-]++){0,64}+-----END [A-Z ]*PRIVATE KEY-----"
_OPEN = r"(?:\s*+(?:Proc-Type|DEK-Info):[^\r\n]*+){0,4}+(?:(?:\s|\\[nr])*+[A-Za-z0-9+/]{16,}+={0,2}+){0,400}+(?:(?:\s|\\[nr])*+[A-Za-z0-9+/]{1,15}+={1,2}+)?+"
#: kind, pattern, group holding the value, least length of the value, whether it is a base kind.
KINDS = (
    ("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6, True),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    ("hex", r"[0-9a-f]{24,}", 0, 24, True),
    ("private", _HEADER + r"((?:" + _CLOSED + "|" + _OPEN + "))", 1, 0, False),
    ("platform", r"(?:gh[opusr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})", 0, 14, False),
    ("bearer", r"[Bb]earer\x20+([A-Za-z0-9+/_.=-]{16,})", 1, 16, False),
)


def _found(text: Column, number: int) -> Column:
    """Matches of one kind, each with the length of the text since the match before."""
    _, pattern, group, _, _ = KINDS[number]
    same = (lambda v: F.regexp_replace(v, r"\s+|\\[nr]", "")) if KINDS[number][0] == "private" else (lambda v: v)  # a key wrapped otherwise is the same key
    gaps, whole, value = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.transform(
        F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), value.alias("value")),
        lambda x: F.struct(
            F.lit(number).alias("kind"), F.length(x["gap"]).alias("gap"), F.length(x["whole"]).alias("size"),
            F.sha2(same(x["value"]), 256).alias("value"), F.length(x["value"]).alias("value_size"),
        ),
    )
    return F.when(text.rlike(pattern), F.filter(rows, lambda x: x["size"].isNotNull()))


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str = "lang", copied_owners: int = 3) -> DataFrame:
    """One row per finding: doc_id, row (a digest of the text), kind (number), start, end (code points), owners, repositories, live."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.xxhash64(F.col(owner_col)).alias("owner"), F.xxhash64(F.col(owner_col), F.col(repository_col)).alias("repository"),
    )
    rows = rows.select("doc_id", "owner", "repository", F.xxhash64("text").alias("row"), F.explode(F.array(*[_found(F.col("text"), k) for k in range(len(KINDS))])).alias("m"))
    rows = rows.where("m is not null").select("doc_id", "owner", "repository", "row", F.posexplode("m").alias("at", "m")).select("doc_id", "owner", "repository", "row", "at", "m.*")
    rows = rows.dropDuplicates(["doc_id", "row", "kind", "at"])
    order = Window.partitionBy("doc_id", "row", "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.col("size")).over(order)
    least = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS]), F.col("kind") + 1)
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("size")).where(F.col("value_size") >= least)
    rows = cut(rows.select("doc_id", "row", "owner", "repository", "kind", "value", "start", "end"))
    per_repository = rows.groupBy("value", "owner", "repository").agg(F.count("*").alias("n"))
    per_owner = per_repository.groupBy("value", "owner").agg(F.count("*").alias("repositories"))
    spread = cut(per_owner.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories")))  # written: a hot value's rows can be split
    base = F.element_at(F.array(*[F.lit(k[4]) for k in KINDS]), F.col("kind") + 1)
    found = rows.join(spread, "value").withColumn("live", F.col("owners") < copied_owners)
    return found.where(base | F.col("live")).select("doc_id", "row", "kind", "start", "end", "owners", "repositories", "live")


def secret_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: counts, base_sha256, spans, n_live and n_copied."""
    found = find_secrets(docs, id_col=id_col, text_col=text_col, **options)
    names = F.array(*[F.lit(k[0]) for k in KINDS])

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    per_row = found.groupBy("doc_id", "row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("list"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{KINDS[k][0]}") for k in range(3)],
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_copied"),
    )
    per_row = per_row.withColumnsRenamed({"doc_id": "found_id", "row": "found_row"})
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("row"))
    joined = ids.join(per_row, ids["doc_id"].eqNullSafe(per_row["found_id"]) & (ids["row"] == per_row["found_row"]), "left")
    spans = F.coalesce("list", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    zero = F.lit(0).cast("long")
    return joined.select(
        "doc_id", *[F.coalesce(f"n_{k[0]}", zero).alias(f"n_{k[0]}") for k in KINDS[:3]],
        F.sha2(listed(F.filter(spans, lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        listed(spans).alias("spans"), F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_copied", zero).alias("n_copied"),
    )


def redact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", live_mark: str = "<SECRET>", copied_mark: str = "<EXAMPLE-SECRET>", few: int = 250_000, **options) -> DataFrame:
    """``docs``, every row and column, with findings replaced by a mark that tells live-looking from widely copied."""
    found = find_secrets(docs, id_col=id_col, text_col=text_col, **options)
    before = Window.partitionBy("doc_id", "row").orderBy("start", "kind", "end").rowsBetween(Window.unboundedPreceding, -1)
    parts = found.withColumn("done", F.coalesce(F.max("end").over(before), F.lit(0).cast("long"))).where(F.col("end") > F.col("done"))
    mark = F.when(F.col("live"), F.lit(live_mark)).otherwise(F.lit(copied_mark))
    # a finding that begins inside the one before continues it: no second mark
    parts = parts.withColumn("mark", F.when(F.col("start") >= F.col("done"), mark).otherwise(F.lit("")))
    key, row, spans = (fresh(n, docs.columns) for n in ("secret_key", "secret_row", "secret_spans"))
    per_row = cut(parts.groupBy(F.col("doc_id").alias(key), F.col("row").alias(row)).agg(
        F.sort_array(F.collect_list(F.struct("start", "done", "end", "mark"))).alias(spans)
    ))
    text_row = fresh("text_row", docs.columns)
    left = docs.withColumn(text_row, text_digest(text_col))
    held = per_row.select(key, row)
    here = left[id_col].cast("long").eqNullSafe(held[key]) & (left[text_row] == held[row])
    calm = docs.limit(0)
    if held.count() <= few:  # two longs a row, so at most some 25 MB: texts without findings then stay where they are
        calm, left = left.join(F.broadcast(held), here, "left_anti").select(*docs.columns), left.join(F.broadcast(held), here, "left_semi")
    joined = left.join(per_row, left[id_col].cast("long").eqNullSafe(per_row[key]) & (left[text_row] == per_row[row]), "left")
    text = F.col(text_col)
    pieces = F.transform(spans, lambda s: F.concat(F.substring(text, s["done"].cast("int") + 1, F.greatest(s["start"] - s["done"], F.lit(0)).cast("int")), s["mark"]))
    tail = F.substring(text, F.array_max(F.transform(spans, lambda s: s["end"])).cast("int") + 1, F.length(text))
    clean = F.when(F.col(spans).isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), tail))
    return joined.withColumn(text_col, clean).select(*docs.columns).unionByName(calm)


def _oracle() -> str:
    """The same result from plain SQL: matches and the gaps between them, summed up to positions.

    Its pattern for private keys is the header alone, so it differs on tables that hold such keys.
    """
    scans = []
    for number, (kind, pattern, group, least, base) in enumerate(KINDS):
        if kind == "private":
            pattern, group, least = _HEADER, 0, 1
        p = pattern.replace("'", "''")
        scans.append(
            f"SELECT doc_id, source, lang, {number} AS kind, {least} AS least, {str(base).lower()} AS base, "
            f"unnest(regexp_extract_all(text, '{p}', 0)) AS whole, unnest(regexp_extract_all(text, '{p}', {group})) AS value, "
            f"unnest(list_transform(string_split_regex(text, '{p}')[:len(regexp_extract_all(text, '{p}', 0))], lambda g: length(g))) AS gap, "
            f"unnest(range(len(regexp_extract_all(text, '{p}', 0)))) AS k FROM documents WHERE regexp_matches(text, '{p}')"
        )
    names = ", ".join(f"'{k[0]}'" for k in KINDS)
    return f"""
WITH m AS ({' UNION ALL '.join(scans)}), e AS (
  SELECT *, sum(gap + length(whole)) OVER (PARTITION BY doc_id, kind ORDER BY k) AS fin FROM m
), f AS (
  SELECT *, fin - length(whole) AS start FROM e WHERE length(value) >= least
), o AS (
  SELECT value, count(DISTINCT coalesce(source, '')) AS owners FROM f GROUP BY value
), s AS (
  SELECT f.doc_id, kind, base, start, fin, owners < 3 AS live, [{names}][kind + 1] || ':' || start::BIGINT || ':' || fin::BIGINT AS span
  FROM f JOIN o USING (value) WHERE base OR owners < 3
), g AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         string_agg(span, ',' ORDER BY start, kind, fin) FILTER (base) AS b, string_agg(span, ',' ORDER BY start, kind, fin) AS spans,
         count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
  FROM s GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM documents d LEFT JOIN g USING (doc_id)
"""


ORACLE = _oracle()
