"""The operators of this package on the driver tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (
    chat,
    decontaminate,
    jaccard,
    langid,
    linededup,
    merkle,
    packing,
    pii,
    quality,
    runs,
    secrets,
    toxicity,
    training_order,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def sql(name: str, text: str) -> None:
    SQL[name] = text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pieces(packed: DataFrame) -> DataFrame:
    """Packed pieces with a checksum in place of their ids."""
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(packing.pack(table(spark, sf_dir, "documents")))


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "benchmark"),
        keep=["doc_id"],
    )
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.n_hit().alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
sql(
    "op1_decontaminate",
    rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all({LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [w]
    ELSE list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) END) AS win
  FROM items),
sizes AS (SELECT DISTINCT len(win) AS n FROM wins),
placed AS (
  SELECT doc_id, n, unnest(range(0, len(w) - n + 1)) AS pos,
    unnest(list_transform(range(1, len(w) - n + 2), lambda i: w[i:i + n - 1])) AS win
  FROM words, sizes WHERE len(w) >= n),
hits AS (SELECT doc_id, pos, n, item_id FROM placed JOIN wins USING (win)),
covered AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS k FROM (SELECT DISTINCT doc_id, pos, n FROM hits))
  GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL)
  GROUP BY doc_id)
SELECT w.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM words w LEFT JOIN covered c ON c.doc_id = w.doc_id LEFT JOIN listed l ON l.doc_id = w.doc_id
""",
)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def language_model(docs: DataFrame) -> langid.Model:
    """Learned from the rows that aren't held out; a row without doc_id is in neither part."""
    return langid.train(docs.filter(~held_out() & F.col("doc_id").isNotNull()))


@query
def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, language_model(docs), keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op9_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup(docs).select("doc_id", "n_lines", "n_removed", "text")


sql(
    "op9_linededup",
    r"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(s))) AS pos, unnest(s) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL)),
bare AS (
  SELECT *, lower(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS b
  FROM lines),
numbered AS (
  SELECT doc_id, pos, b, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS j
  FROM bare WHERE b <> ''),
wins AS (
  SELECT x.doc_id, x.j, {'a': x.b, 'b': y.b, 'c': z.b} AS w
  FROM numbered x JOIN numbered y ON y.doc_id = x.doc_id AND y.j = x.j + 1
  JOIN numbered z ON z.doc_id = x.doc_id AND z.j = x.j + 2),
later AS (
  SELECT doc_id, j FROM wins
  QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, j) > 1),
gone AS (SELECT DISTINCT doc_id, j + k AS j FROM later, (VALUES (0), (1), (2)) t(k)),
gone_lines AS (SELECT n.doc_id, n.pos FROM numbered n JOIN gone g ON g.doc_id = n.doc_id AND g.j = n.j),
shorter AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text
  FROM lines l ANTI JOIN gone_lines g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id),
counted AS (SELECT doc_id, count(*) AS n FROM gone_lines GROUP BY doc_id)
SELECT d.doc_id,
  CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
  coalesce(c.n, 0) AS n_removed,
  CASE WHEN c.n IS NULL THEN d.text ELSE coalesce(s.text, '') END AS text
FROM documents d LEFT JOIN counted c ON c.doc_id = d.doc_id
LEFT JOIN shorter s ON s.doc_id = d.doc_id
""",
)


@query
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


sql(
    "op8_jaccard",
    r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2]) END) AS s
  FROM words),
numbered AS (SELECT doc_id, dense_rank() OVER (ORDER BY s) AS s FROM shingles),
sizes AS (SELECT doc_id, count(*) AS n FROM numbered GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m
  FROM numbered a JOIN numbered b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * m >= 90 * (x.n + y.n - m)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, seen) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT e.b, r.seen FROM reach r JOIN edges e ON e.a = r.node WHERE r.seen < e.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles,
  least(d.doc_id, (SELECT min(seen) FROM reach WHERE node = d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
""",
)


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


sql(
    "op3_quality",
    r"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts),
wins AS (
  SELECT doc_id, unnest(range(len(w) - 2)) AS i,
    unnest(list_transform(range(1, len(w) - 1), lambda k: w[k:k + 2])) AS s
  FROM words WHERE len(w) >= 3),
twice AS (SELECT doc_id, i FROM wins QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) t(k)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM texts)),
full_lines AS (
  SELECT doc_id, source, line, n, regexp_replace(lower(trim(line,
    ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), '[0-9]', '0', 'g') AS key
  FROM lines WHERE n > 0),
dup_lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY doc_id),
hosts AS (SELECT source, count(*) AS size FROM documents GROUP BY source),
often AS (
  SELECT source, key, count(DISTINCT doc_id) AS m FROM full_lines GROUP BY source, key),
many AS (
  SELECT o.source, key FROM often o JOIN hosts h ON h.source IS NOT DISTINCT FROM o.source
  WHERE m > 4 AND 100 * m > 5 * size),
removed AS (
  SELECT f.doc_id, sum(f.n) AS n FROM full_lines f JOIN many m
  ON m.key = f.key AND m.source IS NOT DISTINCT FROM f.source GROUP BY f.doc_id),
counted AS (
  SELECT t.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    coalesce(d.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    coalesce(x.n, 0)::BIGINT AS n_removed
  FROM texts t JOIN words USING (doc_id) LEFT JOIN dup_lines d ON d.doc_id = t.doc_id
  LEFT JOIN repeated r ON r.doc_id = t.doc_id LEFT JOIN removed x ON x.doc_id = t.doc_id),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT *, NOT base_failed AND n_words - n_removed >= 50
  AND 100 * (n_words - n_removed) >= 50 * n_words AS kept
FROM judged
""",
)


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def of(*kinds: str) -> F.Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(secrets.spelled(of(*secrets.KINDS)), 256).alias("base_sha256"),
        secrets.spelled(F.col("spans")).alias("spans"),
        F.array_join(
            F.transform(
                of(*secrets.KINDS), lambda s: F.concat_ws(":", s["n_owners"], s["n_repositories"])
            ),
            ",",
        ).alias("owners_repositories"),
    )


ASSIGN = (
    r"""'(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?"""
    r"([A-Za-z0-9+/_.=-]+)'"
)
sql(
    "op10_secrets",
    r"""
WITH kinds(kind, rank, least) AS (VALUES ('assign', 1, 6), ('access', 2, 20), ('hex', 3, 24)),
found AS (
  SELECT doc_id, source, 'assign' AS kind, text, regexp_extract_all(text, P1) AS m,
    regexp_extract_all(text, P1, 1) AS s, string_split_regex(text, P1) AS g FROM documents
  UNION ALL SELECT doc_id, source, 'access', text, regexp_extract_all(text, P2),
    regexp_extract_all(text, P2), string_split_regex(text, P2) FROM documents
  UNION ALL SELECT doc_id, source, 'hex', text, regexp_extract_all(text, P3),
    regexp_extract_all(text, P3), string_split_regex(text, P3) FROM documents),
pieces AS (
  SELECT doc_id, source, kind, unnest(range(len(m))) AS i, unnest(m) AS w, unnest(s) AS secret,
    unnest(g[1:len(m)]) AS gap FROM found WHERE len(m) > 0),
placed AS (
  SELECT p.doc_id, p.source, p.kind, k.rank, secret, length(w) AS n, k.least,
    sum(length(gap) + length(w)) OVER (PARTITION BY doc_id, p.kind ORDER BY i) AS stop
  FROM pieces p JOIN kinds k ON k.kind = p.kind),
base AS (
  SELECT doc_id, source, kind, rank, secret, stop - n AS start, stop FROM placed
  WHERE length(secret) >= least),
owners AS (
  SELECT secret, count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) AS n,
    count(DISTINCT doc_id) AS m
  FROM base GROUP BY secret),
looks AS (
  SELECT secret, len(list_distinct(string_split(secret, ''))) >= 8
    AND 100 * (length(regexp_replace(regexp_replace(regexp_replace(regexp_replace(secret,
      '[0-9]+', '0', 'g'), '[a-z]+', 'a', 'g'), '[A-Z]+', 'A', 'g'), '[^0aA]+', '-', 'g')) - 1)
      >= 25 * (length(secret) - 1) AS random
  FROM owners),
judged AS (
  SELECT b.*, o.n, o.m, CASE WHEN o.n >= 3 OR o.m > 10 THEN 'copied'
    WHEN l.random THEN CASE WHEN o.n = 1 AND o.m <= 3 THEN 'live' ELSE 'shared' END END AS verdict
  FROM base b JOIN owners o ON o.secret = b.secret JOIN looks l ON l.secret = b.secret),
spans AS (
  SELECT doc_id, kind, rank, start, stop, n, m FROM judged
  UNION SELECT doc_id, verdict, CASE verdict WHEN 'copied' THEN 4 WHEN 'live' THEN 5 ELSE 6 END,
    stop - length(secret), stop, n, m FROM judged WHERE verdict IS NOT NULL),
spelled AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c,
    count(*) FILTER (kind = 'hex') AS x,
    string_agg(concat(kind, ':', start::BIGINT, ':', stop::BIGINT), ',' ORDER BY start, rank, stop)
      FILTER (rank <= 3) AS b,
    string_agg(concat(n, ':', m), ',' ORDER BY start, rank, stop) FILTER (rank <= 3) AS o,
    string_agg(concat(kind, ':', start::BIGINT, ':', stop::BIGINT), ',' ORDER BY start, rank, stop)
      AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(x, 0) AS n_hex,
  sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(o, '') AS owners_repositories
FROM documents d LEFT JOIN spelled s ON s.doc_id = d.doc_id
""".replace("P1", ASSIGN)
    .replace("P2", "'AKIA[A-Z0-9]+'")
    .replace("P3", "'[0-9a-f]+'"),
)


@query
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse(table(spark, sf_dir, "conversations"))


sql(
    "op4_chat",
    r"""
WITH placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS place
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)),
whole AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS turns, count(*) AS n_turns
  FROM placed GROUP BY conv_id),
starts AS (
  SELECT DISTINCT turns[1:k] AS turns
  FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM whole)),
kept AS (
  SELECT min(conv_id) AS conv_id, n_turns FROM whole w
  WHERE NOT EXISTS (SELECT 1 FROM starts s WHERE s.turns = w.turns) GROUP BY turns, n_turns)
SELECT k.conv_id, k.n_turns, place // 256 AS part,
  string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '')
    || '<|im_end|>', chr(10) ORDER BY place) AS text
FROM placed p JOIN kept k ON k.conv_id = p.conv_id
GROUP BY k.conv_id, k.n_turns, place // 256
""",
)


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))

    def of(*kinds: str) -> F.Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.spelled(of(*pii.KINDS)), 256).alias("base_sha256"),
        pii.spelled(F.col("spans")).alias("spans"),
    )


@query
def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.order(table(spark, sf_dir, "documents"))


def toxic_held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs.filter(~toxic_held_out()), labels.filter(~toxic_held_out()))
    found = toxicity.predict(docs, model, keep=["doc_id"])
    return found.select("doc_id", toxic_held_out().alias("held_out"), "score", "predicted")


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth document, by a checksum of its id, is tampered with after the manifest
    was made: its folded root must not be the root any more."""
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    changed = F.translate("text", upper, lower)
    leaves = docs.select(
        "doc_id",
        "source",
        merkle.leaf(*fields, F.col("text")).alias("leaf"),
        F.when(
            F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.leaf(*fields, changed)
        ).alias("tampered"),
    )
    found = merkle.manifest(leaves, carry=["tampered"])
    root = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join(merkle.siblings(F.col("path")), ""), 256).alias("proof_sha256"),
        root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _merkle_sql() -> str:
    """A manifest in plain SQL, for groups of up to 16 ** 6 documents and as many groups."""
    h = 6
    whole = "concat_ws('', " + ", ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
        for c in ("doc_id", "source", "lang", "n_chars", "TEXT")
    ) + ")"
    changed = whole.replace(
        "TEXT", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    )
    bit = "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = f"list_reduce(list_prepend(xor(s, x), range(8)), {bit})"
    parts = [
        f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, sha256({whole.replace("TEXT", "text")}) AS leaf,
    CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      string_split(doc_id::VARCHAR, ''), lambda t: ascii(t)::BIGINT)), lambda s, x: {byte}),
      4294967295) % 5 = 0 THEN sha256({changed}) END AS tampered
  FROM documents),
g0 AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
    count(*) OVER (PARTITION BY source) AS n FROM rows),
a0 AS (SELECT source, n, rank AS i, leaf AS v FROM g0)"""
    ]

    def climb(level: str, keys: str) -> None:
        for k in range(h):
            parts.append(
                f"""
{level}{k}r AS (
  SELECT {keys}n, i // 16 AS i, list(v ORDER BY i) AS vs FROM {level}{k}
  GROUP BY {keys}n, i // 16),
{level}{k + 1} AS (
  SELECT {keys}n, i, CASE WHEN n > {16**k} THEN sha256(array_to_string(vs, '')) ELSE vs[1] END AS v
  FROM {level}{k}r)"""
            )

    climb("a", "source, ")
    parts.append(
        f"""
b0 AS (
  SELECT source, v, count(*) OVER () AS n,
    row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM a{h})"""
    )
    climb("b", "")
    parts.append(
        f"""
w0 AS (
  SELECT g.doc_id, g.source, leaf, b0.v AS subroot, (SELECT v FROM b{h}) AS root, g.rank, g.n,
    b0.i AS place, b0.n AS n_groups, '' AS proof, coalesce(tampered, leaf) AS own
  FROM g0 g JOIN b0 ON b0.source IS NOT DISTINCT FROM g.source)"""
    )
    for step in range(2 * h):
        k = step % h
        below, rank, n = (("a", "rank", "n") if step < h else ("b", "place", "n_groups"))
        same = "r.source IS NOT DISTINCT FROM w.source AND " if step < h else ""
        at = f"(w.{rank} // {16**k} % 16)"
        parts.append(
            f"""
w{step + 1} AS (
  SELECT w.* EXCLUDE (proof, own),
    CASE WHEN w.{n} > {16**k} THEN proof || array_to_string(vs[1:{at}], '')
      || array_to_string(vs[{at} + 2:], '') ELSE proof END AS proof,
    CASE WHEN w.{n} > {16**k} THEN sha256(array_to_string(vs[1:{at}], '') || own
      || array_to_string(vs[{at} + 2:], '')) ELSE own END AS own
  FROM w{step} w JOIN {below}{k}r r ON {same}r.i = w.{rank} // {16 ** (k + 1)})"""
        )
    return ",".join(parts) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, own AS folded_root,
  own = root AS verified FROM w{2 * h}"""


sql("op12_merkle", _merkle_sql())


def planted(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text); where a checksum of the id ends in 0, the words of the text
    joined by spaces, with a stretch of them repeated up to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    step = docs.select(
        "doc_id", "text", h.alias("h"), F.when(h % 10 == 0, quality.split_words(F.col("text"))).alias("w")
    )
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    step = step.withColumn("a", F.when(n > 0, (g % n).cast("int")))
    step = step.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    w, a, p = F.col("w"), F.col("a"), F.col("p")
    altered = F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, a + (i - a) % p)))
    return step.select(
        "doc_id", F.when(n > 0, F.array_join(altered, " ")).otherwise(F.col("text")).alias("text")
    )


@query
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = planted(table(spark, sf_dir, "documents"))
    found = runs.find(docs, keep=["doc_id"])
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"),
                (-r["start"]).alias("start"),
                (-r["period"]).alias("period"),
            ),
        )
    )
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
