"""Secret scans with corpus-wide ownership frequency.

Base kinds are found in every text by their patterns.  A pattern gives a text's pieces (``split``) and its matches
(``regexp_extract_all``); the running length of both gives the positions, in code points.  Beyond the base, any long
run of token characters with letters and digits is a candidate.  Candidates are hashed and counted over the whole
corpus: in how many documents (repositories) and sources (owners) does the same value occur?  A value of several owners
is a widely copied example; one that stays with few is live-looking.  Live tokens join the spans as kind ``token``;
base spans stay and carry their verdict.

Counting has several levels, (value, owner, document), (value, owner), value, so a value that a third of all rows
hold is summed in parts first.  Only values that are examples come back to the spans, once for each of ``SALTS`` salts,
so that the spans of a hot value are joined in as many tasks.

Built from Spark's own functions only.  Defined results: a NULL text is empty and has no spans; a NULL source is an
owner of its own; rows of the same id and text count as one document and get the same spans; an empty table gives an
empty table; extra columns are kept, unless they have the name of a result column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col, fresh, let, stored, text_of

#: Fixed patterns of the base, in the order of their kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
VALUE = r"[A-Za-z0-9+/_.=-]+"
#: Access keys and hex runs are whole runs, so the least length (18 and 16 characters) can stand in the pattern.
ACCESS, HEX = r"AKIA[A-Z0-9]{14,}", r"[0-9a-f]{16,}"
LEAST_VALUE = 12
KINDS = ("assign", "access", "hex", "token")
#: The method's kind: a long run of token characters, judged by its owners.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: A value of at least so many owners is an example.
EXAMPLE_OWNERS = 3
SALTS = 16
SPAN = "struct<start:bigint,kind:int,end:bigint,value:string>"


def spans_of(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost matches of a pattern that is never empty: array of (start, kind, end, value)."""
    steps = F.zip_with(F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")))

    def add(done: Column, s: Column) -> Column:
        start = (done["at"] + s["gap"]).cast("long")
        end = (start + F.coalesce(F.length(s["value"]), F.lit(0))).cast("long")
        hit = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), s["value"].alias("value")).cast(SPAN)
        return F.struct(end.alias("at"), F.when(s["value"].isNull(), done["spans"]).otherwise(F.concat(done["spans"], F.array(hit))).alias("spans"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), none().alias("spans"))
    return F.aggregate(steps, zero, add, lambda d: d["spans"])


def none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def assign_spans(text: Column) -> Column:
    """Matches are taken with values of any length, for a short one still uses up its characters; then short ones go."""
    def value(s: Column) -> Column:
        return F.regexp_replace(s["value"], "^" + ASSIGN, "")

    held = F.filter(spans_of(text, ASSIGN + VALUE, 0), lambda s: F.length(value(s)) >= LEAST_VALUE)
    return F.transform(held, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), value(s).alias("value")).cast(SPAN))


def candidates(text: Column) -> Column:
    """Base spans and the tokens that touch none of them.  Cheap questions come first: most texts have no ``=``, no
    ``AKIA`` and no digit."""
    base = F.concat(
        F.when(text.rlike("[:=]") & text.rlike(ASSIGN + VALUE), assign_spans(text)).otherwise(none()),
        F.when(text.contains("AKIA"), spans_of(text, ACCESS, 1)).otherwise(none()),
        F.when(text.rlike(HEX), spans_of(text, HEX, 2)).otherwise(none()))
    digits = text.rlike("[0-9]")
    tokens = F.filter(spans_of(text, TOKEN, 3), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    tokens = F.when(digits & text.rlike(TOKEN), tokens).otherwise(none())
    return let(base, lambda b: F.concat(b, F.filter(tokens, lambda t: ~F.exists(b, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))))


def examples(found: DataFrame, owners: int) -> DataFrame:
    """Hashes that at least so many owners have, with documents and owners."""
    by_owner = found.groupBy("digest", "owner", "id").agg(F.lit(1).alias("one")).groupBy("digest", "owner").agg(F.sum("one").alias("documents"))
    return by_owner.groupBy("digest").agg(F.sum("documents").alias("documents"), F.count(F.lit(1)).alias("owners")).filter(F.col("owners") >= owners)


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """A row for each (id, text) that has spans: ``id``, ``text_hash`` and ``spans``, an array by start and kind of (start, kind,
    end, digest, verdict, documents, owners); verdict is ``example`` or ``live``, the counts are those of examples."""
    text, = fresh(docs, "text_")
    found = docs.withColumn(text, text_of(text_col)).select(
        col(id_col).alias("id"), col(source_col).cast("string").alias("owner"), F.xxhash64(col(text)).alias("text_hash"), F.explode(candidates(col(text))).alias("s"))
    found = stored(found.select("id", "owner", "text_hash", "s.start", "s.kind", "s.end", F.sha2("s.value", 256).alias("digest")), "candidates")
    copied = examples(found, example_owners).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    copied = copied.withColumnRenamed("digest", "copied")
    salted = found.withColumn("salt_", F.pmod(F.xxhash64("id", "start"), F.lit(SALTS)).cast("int"))
    judged = salted.join(copied, (salted["digest"] == copied["copied"]) & (salted["salt_"] == copied["salt"]), "left")
    judged = judged.withColumn("verdict", F.when(F.col("copied").isNull(), "live").otherwise("example"))
    # the method's own kind only where it is live
    judged = judged.withColumn("span", F.when((F.col("kind") < 3) | (F.col("verdict") == "live"), F.struct(
        "start", "kind", "end", "digest", "verdict", "documents", "owners")))
    return judged.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("span")).alias("spans"))


def with_spans(docs: DataFrame, scanned: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", out_col: str = "spans") -> DataFrame:
    """``docs`` with their spans, empty where nothing was found."""
    key, = fresh(docs, "key_")
    rows = docs.drop(*(c for c in docs.columns if c.lower() == out_col)).withColumn(key, F.xxhash64(text_of(text_col)))
    s = scanned.select(F.col("id").alias("s_id"), "text_hash", "spans")
    joined = rows.join(s, rows[id_col].eqNullSafe(s["s_id"]) & (rows[key] == s["text_hash"]), "left")
    nothing = F.array().cast(scanned.schema["spans"].dataType)
    return joined.select(*[rows[c] for c in rows.columns if c != key], F.coalesce(s["spans"], nothing).alias(out_col))


def listed(spans: Column) -> Column:
    """kind:start:end of sorted spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with every span of their text replaced: ``[SECRET]``, or ``[EXAMPLE]`` for a widely copied value.
    Spans that overlap are replaced as one, live if one of them is.  Only the texts that have candidates are joined with
    their spans; the others pass as they are."""
    scanned = stored(scan(docs, id_col=id_col, text_col=text_col, source_col=source_col), "spans")
    text, (mine,) = text_of(text_col), fresh(docs, "found_")
    hit = (text.rlike("[:=]") & text.rlike(ASSIGN + VALUE)) | text.contains("AKIA") | text.rlike(HEX) | (text.rlike("[0-9]") & text.rlike(TOKEN))
    held = with_spans(docs.filter(hit), scanned, id_col=id_col, text_col=text_col, out_col=mine)

    def replaced(parts: Column) -> Column:
        def end(i: Column) -> Column:
            return F.coalesce(F.get(parts, i)["end"], F.lit(0).cast("long")).cast("int")

        cut = F.transform(parts, lambda p, i: F.concat(
            F.substring(text, end(i - 1) + 1, p["start"].cast("int") - end(i - 1)), F.when(p["live"], "[SECRET]").otherwise("[EXAMPLE]")))
        return F.concat(F.array_join(cut, ""), F.substring(text, end(F.size(parts) - 1) + 1, F.length(text)))

    held = held.withColumn(text_col, F.when(F.size(mine) > 0, let(merged(F.col(mine)), replaced)).otherwise(col(text_col)))
    return docs.filter(~hit).unionByName(held.select(*map(col, docs.columns)))


def merged(spans: Column) -> Column:
    """Sorted spans with the overlapping ones as one: array of (start, end, live)."""
    zero = F.array().cast("array<struct<start:bigint,end:bigint,live:boolean>>")

    def add(done: Column, s: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        live = s["verdict"] == "live"
        alone = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), live.alias("live")))
        both = F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), (last["live"] | live).alias("live")))
        return F.when((F.size(done) == 0) | (s["start"] >= last["end"]), F.concat(done, alone)).otherwise(
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), both))

    return F.aggregate(spans, zero, add)


#: Spans, owners of their values and verdicts in SQL, for ``op9_secrets``: pieces and matches of a pattern give the places.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
pattern(kind, p, g) AS (VALUES (0, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1),
  (1, 'AKIA[A-Z0-9]+', 0), (2, '[0-9a-f]+', 0), (3, '[A-Za-z0-9+/_=-]+', 0)),
m AS (SELECT r, doc_id, source, kind, regexp_split_to_array(t, p) AS gaps, regexp_extract_all(t, p, 0) AS hits,
  CASE g WHEN 1 THEN regexp_extract_all(t, p, 1) ELSE regexp_extract_all(t, p, 0) END AS vals FROM d, pattern),
one AS (SELECT r, doc_id, source, kind, unnest(range(1, len(hits) + 1)) AS i, unnest(hits) AS hit, unnest(vals) AS val, unnest(gaps[1 : len(hits)]) AS gap FROM m),
placed AS (SELECT *, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY r, kind ORDER BY i) AS BIGINT) AS upto FROM one),
found AS (SELECT r, doc_id, source, kind, upto - length(hit) AS start_, upto AS end_, val FROM placed
  WHERE length(val) >= [12, 18, 16, 20][kind + 1] AND (kind < 3 OR regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Za-z]'))),
candidate AS (SELECT * FROM found f WHERE kind < 3
  OR NOT EXISTS (FROM found b WHERE b.kind < 3 AND b.r = f.r AND b.start_ < f.end_ AND f.start_ < b.end_)),
owners AS (SELECT val, count(DISTINCT coalesce(source, chr(1))) AS n FROM candidate GROUP BY val),
judged AS (SELECT r, doc_id, kind, start_, end_, n < 3 AS live, ['assign', 'access', 'hex', 'token'][kind + 1] || ':' || start_ || ':' || end_ AS span
  FROM candidate JOIN owners USING (val) WHERE kind < 3 OR n < 3),
listed AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  count(*) FILTER (kind = 3) AS n_token, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example,
  string_agg(span, ',' ORDER BY start_, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY start_, kind) AS spans,
  string_agg(span, ',' ORDER BY start_, kind) FILTER (NOT live) AS examples FROM judged GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_token, 0) AS n_token, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
  coalesce(examples, '') AS examples
FROM d LEFT JOIN listed USING (r)"""
