"""The registered queries of this package over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from revlens.llm import chat, decontaminate, fingerprints, language_id, license_scan, line_dedup, lm_score, merkle, mixing, quality, simhash, url_filter, whitening
from revlens.llm.text import LOWER, UPPER
from revlens.session import staged

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable) -> Callable:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


SQL_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL_WORD = r"'[^\x20\x09-\x0D]+'"

OP2_SQL = f"""
WITH d AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS place,
         CAST(coalesce(len(regexp_extract_all(text, {SQL_WORD})), 0) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CAST((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS DOUBLE) AS weight FROM s
), f AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) AS cap, 3 * source_size / weight AS fill,
         CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM w
), c AS (
  SELECT *, (total - (sum(cap) OVER o - cap)) / (sum(weight) OVER () - sum(weight) OVER o + weight) AS level FROM f
  WINDOW o AS (ORDER BY fill, source IS NULL, encode(source) ROWS UNBOUNDED PRECEDING)
), l AS (
  SELECT min_by(level, (fill, source IS NULL, encode(coalesce(source, '')))) AS level FROM c WHERE fill >= level
), t AS (
  SELECT source, source_size,
         CASE WHEN l.level IS NULL OR fill < l.level THEN cap ELSE l.level * weight END AS target
  FROM c, l
), o AS (
  SELECT d.*, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS goal,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY place, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, source, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (goal // source_size) * size
            + greatest(least(goal % source_size - before, size), 0) END AS BIGINT) AS taken
FROM o
"""


@query("op2_mixing", OP2_SQL)
def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.in_order(mixing.mix(table(spark, folder, "documents"), schedule=mixing.rotating_schedules))
    return mixed.select(F.col("doc").alias("doc_id"), "source", "size", "source_size", "target", "taken")


OP6_SQL = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no
  FROM documents
), k AS (
  SELECT *, translate(trim(line, {SQL_SPACES}), '{UPPER}', '{LOWER}') AS key FROM l
), shared AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT k.*, shared.last IS NOT NULL AND shared.last <> doc_id AS dropped FROM k LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN NOT dropped THEN line END, chr(10) ORDER BY line_no), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op6_line_dedup", OP6_SQL)
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, folder, "documents"))
    text = F.coalesce("row.text", F.lit(""))
    return kept.select("row.doc_id", "counts.n_lines", "counts.n_dropped", F.sha2(text, 256).alias("kept_sha256"))


@query("op8_simhash")
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select(F.col("doc").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id"))


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumnsRenamed({"doc": "doc_id", "item": "item_id"})


@query("op7_quality")
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents")).withColumnRenamed("doc", "doc_id")


@query("op10_language_id")
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    field = language_id.train(docs.where(~language_id.held_out()).select(F.col("doc_id").alias("doc"), "text", "lang"))
    found = language_id.identify(docs, field)
    return found.select(F.col("doc").alias("doc_id"), language_id.held_out("doc").alias("held_out"), "lang_pred",
                        "score", "n_words", "switches")


@query("op5_lm_score")
def op5_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = lm_score.score(docs, ~language_id.held_out(parts=5))
    return found.select(F.col("doc").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                        "train_tokens", "base_score", "score")


# The given pages carry no dates and come with no lists, so both follow from their rows: a fetch
# time from the page's id, and from each host's and domain's MD5 the days on which it enters and leaves lists.
START, YEAR, DAY = 1_704_067_200, 31_536_000, 86_400


def captures(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").alias("id"), "url", (F.lit(START) + F.col("page_id") * 7919 % YEAR).alias("fetched"))


def list_changes(pages: DataFrame) -> DataFrame:
    hosts = pages.select(url_filter.host_of(F.col("url")).alias("key")).where("key is not null").distinct()
    domains = hosts.select(F.substring_index("key", ".", -2).alias("key")).distinct()
    named = hosts.withColumn("kind", F.lit("host")).union(domains.withColumn("kind", F.lit("domain")))
    named = named.union(hosts.select(F.concat("key", F.lit("/en/")).alias("key"), F.lit("folder")))
    named = staged(named, "hosts")  # seven kinds of changes read it
    v = F.conv(F.substring(F.md5("key"), 1, 7), 16, 10).cast("bigint")
    add = F.lit(START) + v % 200 * DAY

    def change(kind: str, when: str, name: str, action: str, at) -> DataFrame:
        rows = named.withColumn("v", v).where(F.col("kind") == kind).where(when)
        return rows.select(F.lit(name).alias("list"), "key", F.lit(action).alias("action"), at.alias("at"))

    parts = [
        change("host", "v % 3 = 0 or key like '%spam%' or key like '%pills%'", "block", "add", add),
        change("host", "v % 6 = 0", "block", "remove", add + 40 * DAY),
        change("host", "v % 12 = 0", "block", "add", add + 90 * DAY),
        change("domain", "v % 2 = 0", "block", "add", add),
        change("domain", "v % 2 = 0", "block", "remove", add + 60 * DAY),
        change("host", "v % 7 = 0", "allow", "add", add + 20 * DAY),
        change("folder", "v % 5 = 0", "block", "add", add),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


SQL_URL = url_filter.URL
OP9_SQL = f"""
WITH p AS (
  SELECT page_id, url, {START} + page_id * 7919 % {YEAR} AS fetched,
         nullif(regexp_replace(lower(regexp_extract(url, '{SQL_URL}', 1)), '[.]$', ''), '') AS host,
         regexp_extract(url, '{SQL_URL}', 2) AS path
  FROM pages
), hosts AS (SELECT DISTINCT host AS key FROM p WHERE host IS NOT NULL
), domains AS (SELECT DISTINCT array_to_string(list_slice(string_split(key, '.'), -2, -1), '.') AS key FROM hosts
), named AS (
  SELECT *, CAST('0x' || substr(md5(key), 1, 7) AS BIGINT) AS v FROM (
    SELECT key, 'host' AS kind FROM hosts UNION ALL SELECT key, 'domain' FROM domains
    UNION ALL SELECT key || '/en/', 'folder' FROM hosts) AS n
), a AS (SELECT *, {START} + v % 200 * {DAY} AS t FROM named
), changes AS (
  SELECT 'block' AS list, key, 'add' AS action, t AS at_s FROM a WHERE kind = 'host' AND (v % 3 = 0 OR key LIKE '%spam%' OR key LIKE '%pills%')
  UNION ALL SELECT 'block', key, 'remove', t + 40 * {DAY} FROM a WHERE kind = 'host' AND v % 6 = 0
  UNION ALL SELECT 'block', key, 'add', t + 90 * {DAY} FROM a WHERE kind = 'host' AND v % 12 = 0
  UNION ALL SELECT 'block', key, 'add', t FROM a WHERE kind = 'domain' AND v % 2 = 0
  UNION ALL SELECT 'block', key, 'remove', t + 60 * {DAY} FROM a WHERE kind = 'domain' AND v % 2 = 0
  UNION ALL SELECT 'allow', key, 'add', t + 20 * {DAY} FROM a WHERE kind = 'host' AND v % 7 = 0
  UNION ALL SELECT 'block', key, 'add', t FROM a WHERE kind = 'folder' AND v % 5 = 0
), spans AS (
  SELECT * FROM (SELECT *, lead(at_s) OVER (PARTITION BY list, key ORDER BY at_s) AS until_s FROM changes) AS s WHERE action = 'add'
), keys AS (
  SELECT page_id, fetched, n - i + 1 AS width, array_to_string(list_slice(labels, i, n), '.') AS key
  FROM (SELECT page_id, fetched, string_split(host, '.') AS labels, len(string_split(host, '.')) AS n,
               unnest(generate_series(1, len(string_split(host, '.')))) AS i FROM p WHERE host IS NOT NULL) AS h
  UNION ALL SELECT page_id, fetched, 1001, host || '/' || string_split(path, '/')[2] || '/' FROM p
  WHERE host IS NOT NULL AND len(string_split(path, '/')) > 2
), hits AS (
  SELECT page_id, list, spans.key, width, at_s,
         row_number() OVER (PARTITION BY page_id ORDER BY width DESC, list = 'allow' DESC, spans.key DESC, at_s DESC) AS place,
         count(*) OVER (PARTITION BY page_id) AS n
  FROM keys JOIN spans ON keys.key = spans.key AND fetched >= at_s AND (until_s IS NULL OR fetched < until_s)
)
SELECT p.page_id, p.url, CAST(p.fetched AS BIGINT) AS fetched, p.host,
       CASE WHEN p.host IS NULL THEN 'invalid' WHEN hits.page_id IS NULL THEN 'clean' WHEN list = 'allow' THEN 'allowed' ELSE 'blocked' END AS verdict,
       hits.key AS entry, CAST(at_s AS BIGINT) AS since, CAST(coalesce(n, 0) AS BIGINT) AS n_active
FROM p LEFT JOIN hits ON p.page_id = hits.page_id AND place = 1
"""


@query("op9_url_filter", OP9_SQL)
def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return url_filter.judge(captures(pages), list_changes(pages)).withColumnRenamed("id", "page_id")


@query("op3_order_minhash")
def op3_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = fingerprints.compare_edited(table(spark, folder, "documents"))
    return found.select(
        F.col("doc").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("signature")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_signature")).alias("edited_fingerprint"), "near_edited", "near_next")


@query("op1_license_scan")
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = license_scan.fit(spark, license_scan.sample_negatives(docs))
    found = license_scan.scan(docs, model)
    return found.select(F.col("doc").alias("doc_id"), F.array_join("licenses", ",").alias("licenses"),
                        "n_lines", "n_unknown", F.round("probability", 6).alias("probability"))


OP11_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, text, lang, n_chars,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
         || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
         || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
         || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS head,
         replace(text, chr(10), '') AS bare,
         list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
           lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)
         ) % 2 = 1 AS tampers
  FROM documents
), g AS (
  SELECT *, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
         sha256(head || CASE WHEN bare IS NULL THEN '-' ELSE strlen(bare) || ':' || bare END) AS tampered FROM d
), leaves AS (
  SELECT doc_id, source, leaf, CASE WHEN tampers THEN tampered ELSE leaf END AS shown,
         dense_rank() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY source) AS n
  FROM g
), low AS (
  SELECT tree, 0 AS height, CAST(place AS BIGINT) AS place, leaf AS digest, n AS nodes FROM leaves
  UNION ALL
  SELECT tree, height + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (any_value(nodes) + 2) // 3
  FROM low WHERE nodes > 1 GROUP BY tree, height, place // 3
), subroots AS (SELECT tree, height AS depth, digest AS subroot FROM low WHERE nodes = 1
), top AS (
  SELECT 0 AS height, CAST(tree AS BIGINT) AS place, subroot AS digest, (SELECT count(*) FROM subroots) AS nodes FROM subroots
  UNION ALL
  SELECT height + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (any_value(nodes) + 2) // 3
  FROM top WHERE nodes > 1 GROUP BY height, place // 3
), side AS (
  SELECT l.tree, l.place AS leaf_place, s.height AS level, s.place, s.digest, CAST(s.place < l.place // CAST(3 ** s.height AS BIGINT) AS INT) AS before
  FROM leaves l JOIN low s ON s.tree = l.tree AND s.nodes > 1 AND s.place // 3 = l.place // CAST(3 ** (s.height + 1) AS BIGINT)
       AND s.place <> l.place // CAST(3 ** s.height AS BIGINT)
  UNION ALL
  SELECT l.tree, l.place, depth + s.height, s.place, s.digest, CAST(s.place < l.tree // CAST(3 ** s.height AS BIGINT) AS INT)
  FROM leaves l JOIN subroots USING (tree) JOIN top s ON s.nodes > 1 AND s.place // 3 = l.tree // CAST(3 ** (s.height + 1) AS BIGINT)
       AND s.place <> l.tree // CAST(3 ** s.height AS BIGINT)
), sides AS (
  SELECT tree, leaf_place, level, coalesce(string_agg(digest, '' ORDER BY place) FILTER (before = 1), '') AS l,
         coalesce(string_agg(digest, '' ORDER BY place) FILTER (before = 0), '') AS r
  FROM side GROUP BY ALL
), proofs AS (SELECT tree, leaf_place, sha256(string_agg(digest, '' ORDER BY level, place)) AS proof FROM side GROUP BY ALL
), levels AS (SELECT depth, tree, (SELECT max(height) FROM top) AS more FROM subroots
), path AS (
  SELECT l.tree, l.place, 0 AS level, shown AS digest FROM leaves l
  UNION ALL
  SELECT path.tree, path.place, path.level + 1, sha256(coalesce(l, '') || digest || coalesce(r, ''))
  FROM path JOIN levels ON levels.tree = path.tree AND path.level < depth + more
  LEFT JOIN sides ON sides.tree = path.tree AND leaf_place = path.place AND sides.level = path.level
)
SELECT doc_id, leaf, subroot, (SELECT digest FROM top WHERE nodes = 1) AS root,
       coalesce(proof, sha256('')) AS proof_sha256, path.digest AS folded_root,
       path.digest = (SELECT digest FROM top WHERE nodes = 1) AS verified
FROM leaves JOIN subroots USING (tree) JOIN levels USING (tree)
JOIN path ON path.tree = leaves.tree AND path.place = leaves.place AND path.level = levels.depth + more
LEFT JOIN proofs ON proofs.tree = leaves.tree AND leaf_place = leaves.place
"""


@query("op11_merkle", OP11_SQL)
def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampers = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    shown = F.when(tampers, F.translate("text", "\n", "")).otherwise(F.col("text"))
    found = merkle.manifest(docs, merkle.leaf(*head, F.col("text")), "source", "doc_id",
                            doc_id=F.col("doc_id"), shown=merkle.leaf(*head, shown))
    rows = merkle.fold(found, "shown")
    digests = {"leaf": "leaf", "subroot": "subroot", "root": "root", "proof_sha256": "proof", "folded_root": "folded"}
    return rows.select("doc_id", *[F.lower(F.hex(c)).alias(name) for name, c in digests.items()],
                       (F.col("folded") == F.col("root")).alias("verified"))


@query("op12_whitening")
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitening.whole_numbers(table(spark, folder, "embeddings"))
    return whitening.whiten(rows, whitening.fit(rows)).withColumnRenamed("id", "vec_id")


OP13_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')) AS v
), o AS (
  SELECT *, row_number() OVER w AS place, coalesce(lag(role) OVER w, 'start') AS before,
         CASE role WHEN 'system' THEN 6 WHEN 'user' THEN 4 WHEN 'assistant' THEN 9
              ELSE 2 + length(regexp_replace(role, '(\\|### |</turn>|: |")', '\\\1', 'g')) END AS label
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), b AS (
  SELECT *, CASE role WHEN 'system' THEN before IN ('system', 'user', 'assistant') WHEN 'user' THEN before = 'user'
                 WHEN 'assistant' THEN before IN ('start', 'system', 'assistant') ELSE false END AS bad FROM o
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + label + 2 + length(regexp_replace(text, '(\\|### |</turn>)', '\\\1', 'g')) + 8) AS BIGINT) AS formatted_chars,
       NOT bool_or(bad) AND max_by(role, place) = 'assistant' AS valid, min_by(turn, place) FILTER (bad) AS bad_turn
FROM b GROUP BY conv_id
"""


@query("op13_chat", OP13_SQL)
def op13_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = chat.turns(table(spark, folder, "conversations"))
    planted = spark.range(2).select(
        F.lit(-7).alias("conversation"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"))
    rows = rows.union(planted.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema]))
    found = chat.read_back(chat.segments(rows))
    checked = chat.verdicts(rows).withColumnRenamed("conversation", "_same")
    found = found.join(checked, F.col("conversation").eqNullSafe(F.col("_same"))).drop("_same")
    return found.withColumnRenamed("conversation", "conv_id")
