"""Document fingerprints: a Merkle tree over sections, paragraphs and short runs of words, in DataFrame operations only.

Sections end at blank lines, paragraphs at line ends, leaves after eight words or at a word with closing punctuation; each of a text's
first words is a leaf of its own, so that short texts have branches too.  The leaves together are the whole text.  A node's digest is that of its children's digests, so equal roots mean equal texts, and what differs is found by
going down the branches that differ.  A fingerprint is written out as::

    root(32) '|' section '|' section ...
    section = digest(8) ';' paragraph ';' paragraph ...
    paragraph = digest(8) '.' leaf '.' leaf ...
    leaf = digest(8) length

Two fingerprints are alike by the length of the leaves they share, each as often as both have it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from terraloom.llm.common import stored

BLANK = "\\x20\\x09-\\x0D"
SECTION = "(?s).+?\\n{2,}|.+"
PARAGRAPH = "[^\\n]+\\n*|\\n+"
LEAF = f"(?:[^{BLANK}]*[^{BLANK}.,;:!?][{BLANK}]+){{0,7}}[^{BLANK}]+[{BLANK}]*|[{BLANK}]+"
HEAD = f"^[{BLANK}]*(?:[^{BLANK}]+[{BLANK}]+){{0,16}}"  # of the first paragraph
HEAD_LEAF = f"[^{BLANK}]+[{BLANK}]*|[{BLANK}]+"
ROOT, SHORT = 32, 8  # digits written of a root and of other digests
BUCKET_BYTES = 64 << 20
HOT = 10_000  # rows that repeat both key and text above which they travel as one
SPREAD = 2**60


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\") + "'"


def _all(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, {_quoted(pattern)}, 0)"


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the fingerprint of a text column without nulls.  Each level is a column of its own, so that none is worked out twice."""
    head = f"regexp_extract(p, {_quoted(HEAD)}, 0)"
    first = f"concat({_all(head, HEAD_LEAF)}, {_all(f'substr(p, char_length({head}) + 1)', LEAF)})"
    return (
        df.withColumn("_leaves", F.expr(
            f"transform({_all(text, SECTION)}, (s, i) -> transform({_all('s', PARAGRAPH)}, (p, j) -> transform("
            f"CASE WHEN i + j = 0 THEN {first} ELSE {_all('p', LEAF)} END, l -> concat(sha2(l, 256), char_length(l)))))"))
        .withColumn("_paragraphs", F.expr(
            "transform(_leaves, s -> transform(s, p -> struct(sha2(array_join(transform(p, l -> left(l, 64)), ''), 256) AS d, "
            f"array_join(transform(p, l -> concat('.', left(l, {SHORT}), substr(l, 65))), '') AS t)))"))
        .withColumn("_sections", F.expr(
            "transform(_paragraphs, s -> struct(sha2(array_join(transform(s, p -> p.d), ''), 256) AS d, "
            f"array_join(transform(s, p -> concat(';', left(p.d, {SHORT}), p.t)), '') AS t))"))
        .withColumn(out, F.expr(
            f"concat(left(sha2(array_join(transform(_sections, s -> s.d), ''), 256), {ROOT}), "
            f"array_join(transform(_sections, s -> concat('|', left(s.d, {SHORT}), s.t)), ''))"))
        .drop("_leaves", "_paragraphs", "_sections")
    )


def _runs(of: str) -> str:
    """(leaf, how often) from a sorted array of leaves."""
    return (
        f"transform(_at{of}, (i, k) -> struct({of}[i] AS t, coalesce(get(_at{of}, k + 1), size({of})) - i AS n))")


def with_likeness(df: DataFrame, first: str, second: str, out: str) -> DataFrame:
    """Add the likeness of two fingerprint columns, 0 to 1: twice the length of shared leaves over that of all; two without leaves are alike."""
    for name, of in ((first, "_a"), (second, "_b")):
        df = df.withColumn(of, F.expr(
            f"sort_array(filter(split(substr({name}, {ROOT + 1}), '[|;.]'), t -> length(t) > {SHORT}))"))
    for of in ("_a", "_b"):
        df = df.withColumn(f"_at{of}", F.expr(
            f"CASE WHEN size({of}) > 0 THEN filter(sequence(0, size({of}) - 1), i -> i = 0 OR {of}[i] <> {of}[i - 1]) ELSE array() END"))
    length = f"bigint(substr({{}}, {SHORT + 1}))"
    return (
        df.withColumn("_both", F.expr(f"sort_array(concat({_runs('_a')}, {_runs('_b')}))"))
        .withColumn("_shared", F.expr(
            "aggregate(sequence(0, size(_both)), 0L, (sum, i) -> sum + CASE WHEN get(_both, i).t = get(_both, i + 1).t "
            f"THEN get(_both, i).n * {length.format('get(_both, i).t')} ELSE 0L END)"))
        .withColumn("_whole", F.expr(f"aggregate(concat(_a, _b), 0L, (sum, t) -> sum + {length.format('t')})"))
        .withColumn(out, F.expr("CASE WHEN _whole = 0 THEN 1.0D ELSE 2 * _shared / double(_whole) END"))
        .drop("_a", "_b", "_at_a", "_at_b", "_both", "_shared", "_whole")
    )


def with_edit_start(df: DataFrame, first: str, second: str, out: str) -> DataFrame:
    """Add how many code points of the first text lie before the first leaf that differs; null where the roots are equal.

    Of each level only the first branch whose digests differ is opened.
    """
    lengths = f"aggregate(filter(split({{}}, '[|;.]'), t -> length(t) > {SHORT}), 0L, (sum, t) -> sum + bigint(substr(t, {SHORT + 1})))"
    df = df.withColumn("_x", F.expr(f"substr({first}, {ROOT + 2})")).withColumn("_y", F.expr(f"substr({second}, {ROOT + 2})")).withColumn("_n", F.lit(0).cast("bigint"))
    for between in "|;.":
        head = f"left({{}}, {SHORT})" if between != "." else "{}"
        parts = "split({}, '[" + between + "]')"
        df = (
            df.withColumn("_p", F.expr(parts.format("_x"))).withColumn("_q", F.expr(parts.format("_y")))
            .withColumn("_i", F.expr(f"array_position(zip_with(_p, _q, (a, b) -> NOT ({head.format('a')} <=> {head.format('b')})), true)"))
            .withColumn("_n", F.expr(f"_n + {lengths.format(f'array_join(slice(_p, 1, greatest(int(_i) - 1, 0)), {chr(39)}{between}{chr(39)})')}"))
            .withColumn("_x", F.expr(f"coalesce(substr(get(_p, int(_i) - 1), {SHORT + 2}), '')"))
            .withColumn("_y", F.expr(f"coalesce(substr(get(_q, int(_i) - 1), {SHORT + 2}), '')"))
        )
    return df.withColumn(out, F.expr(f"CASE WHEN left({first}, {ROOT}) <> left({second}, {ROOT}) THEN _n END")).drop("_x", "_y", "_n", "_p", "_q", "_i")


def _below(bounds: list[int], value: str, ties: bool) -> list[tuple[str, str]]:
    """Columns of a binary search: how many sorted bounds lie below a value, or not above it with ``ties``."""
    name, steps = "_hi" if ties else "_lo", len(bounds).bit_length()
    table = f"cast(split('{','.join(map(str, bounds))}', ',') AS array<bigint>)"
    out = [(name, "0")]
    for step in (1 << i for i in range(steps - 1, -1, -1)):
        out.append((name, f"CASE WHEN get({table}, {name} + {step - 1}) {'<=' if ties else '<'} {value} THEN {name} + {step} ELSE {name} END"))
    return out


def _placed(rows: DataFrame, bounds: list[int], keyless: int) -> DataFrame:
    """Add ``_bucket``: contiguous in the order of descending (id, digest).  An id that fills several buckets is cut by digest, and so are rows without one."""
    for name, search in (*_below(bounds, "_id", False), *_below(bounds, "_id", True)):
        rows = rows.withColumn(name, F.expr(search))
    share = f"double(conv(substr(_sha, 1, 15), 16, 10)) / {SPREAD}D"
    return rows.withColumn("_bucket", F.expr(
        f"CASE WHEN _id IS NULL THEN -1 - bigint(floor((1 - {share}) * {keyless})) "
        f"ELSE _lo + bigint(floor({share} * (_hi - _lo + 1))) END")).drop("_lo", "_hi")


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES, hot: int = HOT) -> DataFrame:
    """``_id``, ``_text``, ``_fp`` and ``_next``, the text and fingerprint of the next row by descending key, after the last the first.

    Rows of one key follow one another by descending SHA-256 of the text, rows without a key come last.  Texts move once, into buckets
    that are contiguous in this order and bounded by quantiles of the key; the first row of a bucket visits the bucket before it, which
    takes one short row per bucket through the driver.  A row that repeats both key and text above ``hot`` times travels once with its count.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("bigint").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")).withColumn("_sha", F.sha2("_text", 256))
    size, n, known = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)), F.count("*"), F.count("_id")).first()
    buckets = max(-(-size // bucket_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = []
    if known and buckets > 1:
        shares = F.split(F.lit(",".join(repr(i / buckets) for i in range(1, buckets))), ",").cast("array<double>")
        bounds = sorted(rows.agg(F.percentile_approx("_id", shares, max(10_000, 20 * buckets))).first()[0])
    placed = _placed(rows, bounds, max(1, buckets * (n - known) // max(n, 1)))
    repeated = sorted({b for b, c in zip(bounds, bounds[1:]) if b == c})
    crowded = F.col("_id").isNull() if known < n else F.lit(False)
    if repeated:
        crowded = crowded | F.col("_id").isin(repeated)
    often = placed.where(crowded).groupBy("_id", "_sha").count().where(F.col("count") > hot).select(F.col("_id").alias("_i"), F.col("_sha").alias("_s"))
    same = (F.col("_id").eqNullSafe(F.col("_i"))) & (F.col("_sha") == F.col("_s"))
    light = placed.select("_bucket", "_id", "_sha")
    firsts = light.groupBy("_bucket").agg(F.max(F.struct("_id", "_sha")).alias("h")).orderBy(F.col("_bucket").desc()).collect()
    placed = placed.withColumn("_n", F.lit(1).cast("bigint"))
    if (repeated or known < n) and not (often := stored(often, "repeated")).isEmpty():  # at most rows / hot of them
        merged = placed.join(F.broadcast(often), same, "left_semi").groupBy("_bucket", "_id", "_sha").agg(
            F.first("_text").alias("_text"), F.count("*").alias("_n"))
        placed = placed.join(F.broadcast(often), same, "left_anti").unionByName(merged)
    visits = [(r.h._id, r.h._sha, firsts[i - 1]._bucket) for i, r in enumerate(firsts)]  # the first of all visits the last bucket
    visiting = F.broadcast(spark.createDataFrame(visits, "_i bigint, _s string, _visits bigint"))
    stays = placed.join(visiting, same, "left").select(
        "_id", "_sha", "_text", "_n", F.explode(F.filter(F.array(
            F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("guest")), F.struct(F.col("_visits").alias("bucket"), F.lit(True).alias("guest"))),
            lambda s: s["bucket"].isNotNull())).alias("_stay"))
    dealt = stays.select(F.col("_stay.bucket").alias("_bucket"), F.col("_stay.guest").alias("_guest"), "_id", "_sha", "_text", "_n").repartition("_bucket")
    order = Window.partitionBy("_bucket").orderBy("_guest", F.col("_id").desc_nulls_last(), F.col("_sha").desc())
    here = F.struct(F.col("_text").alias("text"), F.col("_fp").alias("fp"))
    found = with_fingerprint(dealt, "_text", "_fp").withColumn("_after", F.lead(here).over(order)).where(~F.col("_guest"))
    each = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_n")))
    return each.select("_id", "_text", "_fp", F.when(F.col("_copy") < F.col("_n"), here).otherwise(F.col("_after")).alias("_next"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Every document's fingerprint beside those of an edited text and of the next document.

    The edited text has its last third, in code points, replaced by as many of the first of the next document, in descending order of
    the key.  ``edit_start`` says where the first differing leaf begins.  A null text is empty: its fingerprint is a root without
    branches, alike only to itself; a document that is alone is followed by itself; repeated rows follow one another; rows without a key
    come last; no documents give no rows.
    """
    third = F.floor(F.char_length("_text") / 3).cast("int")
    edited = (
        with_next(docs, key, text, **options).withColumn("n_chars", F.char_length("_text").cast("bigint"))
        .withColumn("_edited", F.concat(F.expr("left(_text, int(n_chars - floor(n_chars / 3)))"), F.left(F.col("_next.text"), third)))
        .select("_id", "n_chars", "_edited", "_fp", F.col("_next.fp").alias("_next_fp"))
    )
    both = with_fingerprint(edited.withColumn("edited_sha256", F.sha2("_edited", 256)), "_edited", "_edited_fp")
    alike = with_likeness(with_likeness(both, "_fp", "_edited_fp", "near_edited"), "_fp", "_next_fp", "near_next")
    row = F.struct(
        F.col("_id").alias(key), "n_chars", "edited_sha256", F.col("_fp").alias("fingerprint"), F.col("_edited_fp").alias("edited_fingerprint"),
        "near_edited", "near_next", "edit_start")
    # A generator keeps later filters above the expressions, which they would otherwise repeat once per use.
    return with_edit_start(alike, "_fp", "_edited_fp", "edit_start").select(F.explode(F.array(row)).alias("row")).select("row.*")


def _sql_node(children: str, of: str) -> str:
    """Digest and written form of a node for DuckDB, from a list of its children's."""
    joined = "coalesce(list_aggregate(list_transform({}, lambda x: {}), 'string_agg', ''), '')"
    return f"{{'d': sha256({joined.format(children, 'x.d')}), 't': {joined.format(children, of)}}}"


_SQL_HEAD = f"regexp_extract(p, '{HEAD}')"
_SQL_LEAVES = (
    f"list_transform(CASE WHEN i + j = 2 THEN regexp_extract_all({_SQL_HEAD}, '{HEAD_LEAF}') || regexp_extract_all(substr(p, length({_SQL_HEAD}) + 1), '{LEAF}') "
    f"ELSE regexp_extract_all(p, '{LEAF}') END, lambda l: {{'d': sha256(l), 't': length(l)::VARCHAR}})")
_SQL_PARAGRAPHS = f"list_transform(regexp_extract_all(s, '{PARAGRAPH}'), lambda p, j: " + _sql_node(_SQL_LEAVES, f"'.' || left(x.d, {SHORT}) || x.t") + ")"
_SQL_SECTIONS = f"list_transform(regexp_extract_all(t, '{SECTION}'), lambda s, i: " + _sql_node(_SQL_PARAGRAPHS, f"';' || left(x.d, {SHORT}) || x.t") + ")"

ORACLE = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, sha256(coalesce(text, '')) DESC) AS r FROM documents),
pairs AS (
  SELECT d.doc_id, d.r, length(d.t) AS n, d.t, left(d.t, length(d.t) - length(d.t) // 3) || left(x.t, length(d.t) // 3) AS edited, x.r AS next_r
  FROM docs d JOIN docs x ON x.r = d.r % (SELECT count(*) FROM docs) + 1),
texts AS (SELECT r, 'a' AS kind, t FROM pairs UNION ALL SELECT r, 'b', edited FROM pairs),
nodes AS (SELECT r, kind, {_sql_node(_SQL_SECTIONS, f"'|' || left(x.d, {SHORT}) || x.t")} AS node FROM texts),
trees AS (SELECT r, kind, left(node.d, {ROOT}) || node.t AS fp FROM nodes),
lists AS (
  SELECT r, kind, fp, list_filter(string_split_regex(substr(fp, {ROOT + 1}), '[|;.]'), lambda x: length(x) > {SHORT}) AS leaves FROM trees),
tokens AS (
  SELECT r, kind, leaf, count(*) AS n, substr(leaf, {SHORT + 1})::BIGINT AS size FROM (SELECT r, kind, unnest(leaves) AS leaf FROM lists) GROUP BY ALL),
wholes AS (SELECT r, kind, sum(n * size) AS size FROM tokens GROUP BY ALL),
asked AS (
  SELECT r, r AS other, 'b' AS kind FROM pairs UNION ALL SELECT r, next_r, 'a' FROM pairs),
shared AS (
  SELECT q.r, q.kind, sum(least(x.n, y.n) * x.size) AS size FROM asked q
  JOIN tokens x ON x.r = q.r AND x.kind = 'a' JOIN tokens y ON y.r = q.other AND y.kind = q.kind AND y.leaf = x.leaf GROUP BY ALL),
near AS (
  SELECT q.r, q.kind, CASE WHEN coalesce(x.size, 0) + coalesce(y.size, 0) = 0 THEN 1 ELSE (2 * coalesce(s.size, 0))::DOUBLE / (coalesce(x.size, 0) + coalesce(y.size, 0))::DOUBLE END AS near
  FROM asked q LEFT JOIN wholes x ON x.r = q.r AND x.kind = 'a' LEFT JOIN wholes y ON y.r = q.other AND y.kind = q.kind
  LEFT JOIN shared s ON s.r = q.r AND s.kind = q.kind)
SELECT p.doc_id, p.n::BIGINT AS n_chars, sha256(p.edited) AS edited_sha256, a.fp AS fingerprint, b.fp AS edited_fingerprint,
  e.near::DOUBLE AS near_edited, x.near::DOUBLE AS near_next,
  CASE WHEN left(a.fp, {ROOT}) <> left(b.fp, {ROOT}) THEN coalesce(list_sum(list_transform(a.leaves[:coalesce(list_min(list_filter(
    range(1, greatest(len(a.leaves), len(b.leaves)) + 1), lambda i: a.leaves[i] IS DISTINCT FROM b.leaves[i])), 1) - 1],
    lambda l: substr(l, {SHORT + 1})::BIGINT)), 0)::BIGINT END AS edit_start
FROM pairs p JOIN lists a ON a.r = p.r AND a.kind = 'a' JOIN lists b ON b.r = p.r AND b.kind = 'b'
JOIN near e ON e.r = p.r AND e.kind = 'b' JOIN near x ON x.r = p.r AND x.kind = 'a'"""
