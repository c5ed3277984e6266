"""Registered queries over the given tables, each with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import (
    chat, decontaminate, fill_middle, merkle, mixing, ngram_join, quality, sharding, suffix_dedup, token_counts, token_files, url_filters, warc,
)
from lakeloom.llm.workers import find_package
from lakeloom.session import scratch, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark = find_package(tune(spark))
            return fn(spark, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return wrap


def url_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries drawn from the pages' own hosts, so that the lists grow with the captures."""
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    full = url_filters.address(F.col("url"))
    host = F.substring_index(full, "/", 1)
    hosts = pages.groupBy(host.alias("host")).agg(F.min("page_id").alias("lo"), F.count(F.lit(1)).alias("n"))
    listed = hosts.select(F.lit("hosts").alias("list"), F.lit("block").alias("action"), F.lit("domain").alias("scope"),
                          F.col("host").alias("key"), F.explode(F.array(
                              F.struct(day(F.col("lo") * 7 % 200).alias("day"), F.lit(True).alias("present")),
                              F.struct(day(F.col("lo") * 7 % 200 + 30 + F.col("n") * 13 % 90).alias("day"), F.lit(False).alias("present")),
                              F.struct(day(F.col("lo") * 7 % 200 + 150).alias("day"), (F.col("lo") % 5 == 0).alias("present")),
                          )).alias("e")).filter(F.length("key") % 2 == 0)
    parents = hosts.groupBy(F.substring_index("host", ".", -2).alias("key")).agg(F.min("lo").alias("lo")).select(
        F.lit("parents").alias("list"), F.lit("block").alias("action"), F.lit("domain").alias("scope"), "key",
        F.explode(F.array(F.struct(day(F.col("lo") % 100 + 60).alias("day"), F.lit(True).alias("present")),
                          F.struct(day(F.col("lo") % 100 + 75).alias("day"), F.lit(False).alias("present")))).alias("e"))
    paths = pages.filter(F.size(F.split(full, "/")) > 2).groupBy(
        F.concat(F.substring_index(full, "/", 2), F.lit("/")).alias("key")).agg(F.min("page_id").alias("lo")).filter("lo % 4 = 1").select(
        F.lit("sections").alias("list"), F.lit("allow").alias("action"), F.lit("prefix").alias("scope"), "key",
        F.struct(day(F.col("lo") % 150).alias("day"), F.lit(True).alias("present")).alias("e"))
    return listed.unionByName(parents).unionByName(paths).select("list", "action", "scope", "key", "e.day", "e.present")


@query("""
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS day,
    regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '[?#].*$', '') AS bare FROM pages),
a AS (SELECT page_id, url, day, lower(regexp_replace(regexp_replace(split_part(bare, '/', 1), '^.*@', ''), ':[0-9]*$', '')) AS host,
    CASE WHEN substr(bare, length(split_part(bare, '/', 1)) + 1) = '' THEN '/' ELSE substr(bare, length(split_part(bare, '/', 1)) + 1) END AS path FROM p),
hosts AS (SELECT host, min(page_id) AS lo, count(*) AS n FROM a GROUP BY host),
ends AS (SELECT host, lo, DATE '2024-01-01' + CAST(lo * 7 % 200 AS INTEGER) AS d1,
    DATE '2024-01-01' + CAST(lo * 7 % 200 + 30 + n * 13 % 90 AS INTEGER) AS d2,
    DATE '2024-01-01' + CAST(lo * 7 % 200 + 150 AS INTEGER) AS d3 FROM hosts WHERE length(host) % 2 = 0),
spans AS (
  SELECT 'hosts' AS list, 'block' AS action, 'domain' AS scope, host AS key, d1 AS since, d2 AS until FROM ends
  UNION ALL SELECT 'hosts', 'block', 'domain', host, d3, NULL FROM ends WHERE lo % 5 = 0
  UNION ALL SELECT 'parents', 'block', 'domain', list_aggregate(string_split(host, '.')[-2:], 'string_agg', '.') AS key,
      DATE '2024-01-01' + CAST(min(lo) % 100 + 60 AS INTEGER), DATE '2024-01-01' + CAST(min(lo) % 100 + 75 AS INTEGER) FROM hosts GROUP BY key
  UNION ALL SELECT 'sections', 'allow', 'prefix', host || '/' || split_part(path, '/', 2) || '/' AS key,
      DATE '2024-01-01' + CAST(min(page_id) % 150 AS INTEGER), NULL FROM a WHERE length(path) - length(replace(path, '/', '')) > 1
      GROUP BY key HAVING min(page_id) % 4 = 1),
hit AS (
  SELECT a.page_id, s.*, CASE WHEN scope = 'domain' THEN length(key) - length(replace(key, '.', '')) + 1
      ELSE 1000 + length(key) - length(replace(key, '/', '')) END AS rank
  FROM a JOIN spans s ON a.day >= s.since AND (s.until IS NULL OR a.day < s.until)
    AND (scope = 'domain' AND (a.host = key OR ends_with(a.host, '.' || key)) OR scope = 'prefix' AND starts_with(a.host || a.path, key))),
best AS (SELECT * FROM hit QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY rank DESC, action = 'allow', list, since) = 1)
SELECT a.page_id, a.url, strftime(a.day, '%Y-%m-%d') AS fetched, coalesce(b.action <> 'block', TRUE) AS url_allowed, b.list AS url_list,
  b.key AS url_key, strftime(b.since, '%Y-%m-%d') AS url_since
FROM a LEFT JOIN best b USING (page_id)
""")
def op2_url_filters(spark, table):
    pages = table("pages")
    captures = pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 366).cast("int")).alias("fetched"))
    judged = url_filters.judge(captures, url_entries(pages))
    return judged.withColumns({c: F.col(c).cast("string") for c in ("fetched", "url_since")})


@query(r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS shingle
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY x, y),
link AS (SELECT x, y FROM met JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, e.y FROM reach r JOIN edge e ON e.x = r.other)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, min(other) AS component_id
FROM w JOIN reach r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY ALL
""")
def op3_ngram_join(spark, table):
    return ngram_join.join(table("documents"))


@query(r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS shingle
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY x, y),
link AS (SELECT x, y FROM met JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, e.y FROM reach r JOIN edge e ON e.x = r.other)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, min(other) AS component_id, (SELECT count(*) FROM edge WHERE x = w.doc_id) AS n_links
FROM w JOIN reach r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY w.doc_id, n.n
""")
def op3_ngram_links(spark, table):
    return ngram_join.join_counts(table("documents"))


@query(r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    list_filter(list_transform(string_split(regexp_replace(regexp_replace(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g'),
      '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS plain FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM d WHERE len(words) > 2),
t AS (SELECT doc_id, i, list_aggregate(words[i:i + 2], 'string_agg', ' ') AS tri FROM w),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM t QUALIFY count(*) OVER (PARTITION BY doc_id, tri) > 1) GROUP BY doc_id),
l AS (SELECT doc_id, host, text, unnest(plain) AS line FROM d),
f AS (SELECT host, line FROM l GROUP BY host, line HAVING count(DISTINCT text) > 20),
g AS (SELECT doc_id, sum(len(string_split(line, ' '))) AS n FROM l SEMI JOIN f USING (host, line) GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(g.n, 0) AS BIGINT) AS gone
  FROM d LEFT JOIN r USING (doc_id) LEFT JOIN g USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - gone >= 0.5 * n_words AS kept,
  n_words - gone AS left_words
FROM m
""")
def op6_quality(spark, table):
    return quality.judge(table("documents")).drop("host", "text_hash", "frequent")


@query()
def op7_sharding(spark, table):
    return sharding.shard(table("documents"), [1.0] * 8, [1.0] * 9)


@query()
def op9_decontamination(spark, table):
    found = decontaminate.matches(table("documents"), table("benchmark"))
    return found.filter("leaked").drop("key", "leaked")


@query()
def op5_mixing(spark, table):
    # domains: the sources by their number's parity; weights: even sources count double, English half
    number = F.regexp_extract("source", "([0-9]+)$", 1).cast("int") % 2
    domain = F.when(number == 0, F.lit("even")).otherwise(F.lit("odd"))
    weight = F.when(F.col("domain") == "even", 2.0).otherwise(1.0) * F.when(F.col("lang") == "en", 0.5).otherwise(1.0)
    return mixing.mix(table("documents"), weight, domain=domain)


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT page_id, strlen(html) AS n, sha256(html) AS digest, min(page_id) OVER (PARTITION BY html) AS lo FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 100 AND page_id > lo THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id > lo THEN lo END AS refers_to, TRUE AS verified
FROM f
""")
def op10_warc(spark, table):
    path = scratch(spark, "warc")
    warc.write(table("pages"), path)
    return warc.pages_of(warc.read(spark, path))


@query()
def op1_token_counts(spark, table):
    import public_tokenizers

    counted = token_counts.prefix_counts(table("documents"), public_tokenizers.path("byte_bpe_50k.json"), changes=False)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > token_counts.LIMIT).alias("over_limit"), "limit_chars")


@query()
def op4_suffix_dedup(spark, table):
    found = suffix_dedup.dedup(table("documents"))
    kept = F.octet_length("kept").cast("long").alias("n_kept")  # n_bytes is the input's size
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), kept, "text")


@query()
def op8_token_files(spark, table):
    import public_tokenizers

    path = scratch(spark, "tokens")
    token_files.write(table("documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read(spark, path, token_files.checksum, pa.schema([("ids_crc32", pa.int64())]))


#: Conversation -7: both turns say what templates use as control strings.
CONTROLS = "\\### Assistant: </turn> ok"


@query(r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
m AS (SELECT *, CASE WHEN role = 'assistant' THEN [] ELSE
    regexp_extract_all(text, '!?\[[^\]\n]*\]\([^()\s]+\.(?i:png|jpe?g|gif|webp|wav|mp3|flac|ogg|pdf|docx?|odt)\)') END AS links,
  CASE WHEN role = 'assistant' THEN text ELSE
    regexp_replace(text, '!?\[[^\]\n]*\]\([^()\s]+\.(?i:png|jpe?g|gif|webp|wav|mp3|flac|ogg|pdf|docx?|odt)\)', chr(1), 'g') END AS rest FROM c),
e AS (SELECT *, length('<turn><says></turn>') + 1 + length(regexp_replace(role, '(\\|<turn>|<says>|</turn>|<image:|<audio:|<document:|<other:)', '\\\1', 'g'))
    + length(regexp_replace(rest, '(\\|<turn>|<says>|</turn>|<image:|<audio:|<document:|<other:)', '\\\1', 'g')) - len(links)
    + coalesce(list_sum(list_transform(links, lambda x, i: length('<' || CASE WHEN regexp_matches(lower(x), '\.(png|jpe?g|gif|webp)\)$') THEN 'image'
      WHEN regexp_matches(lower(x), '\.(wav|mp3|flac|ogg)\)$') THEN 'audio' ELSE 'document' END || ':' || i || '>'))), 0) AS size FROM m)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars, CAST(sum(len(links)) AS BIGINT) AS n_attachments
FROM e GROUP BY conv_id
""")
def op11_chat_formatting(spark, table):
    import public_tokenizers

    both = spark.createDataFrame([(-7, 0, "user", CONTROLS), (-7, 1, "assistant", CONTROLS)], "conv_id long, turn long, role string, text string")
    messages = table("conversations").select("conv_id", "turn", "role", "text").unionByName(both)
    # what is learned stays one text; files linked elsewhere become parts
    content = F.when(F.col("role") == "assistant", chat.text_parts(F.col("text"))).otherwise(chat.linked_parts(F.col("text")))
    path = scratch(spark, "chat")
    chat.format_turns(messages, content, tokenizer=public_tokenizers.path("byte_bpe_50k.json")).write.parquet(path)
    return chat.digests(chat.read_turns(spark, path))


@query(r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
x AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS one, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS two,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
f AS (SELECT *, least(one, two) AS a, greatest(one, two) AS b, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
    OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
    ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END) AS output_sha256, sha256(t) AS restored_sha256
FROM f
""")
def op12_fill_middle(spark, table):
    made = fill_middle.transform(table("documents"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(back, 256).alias("restored_sha256"))


@query(r"""
WITH RECURSIVE d AS (SELECT *, CAST(doc_id AS VARCHAR) AS id FROM documents),
c AS (SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(id, ''), lambda x:
    list_transform(range(8), lambda i: CAST((ord(x) >> i) & 1 AS BIGINT))))), lambda a, b:
    xor(a >> 1, CASE WHEN xor(a & 1, b) = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)), CAST(4294967295 AS BIGINT)) AS crc FROM d),
t AS (SELECT *, CASE WHEN crc % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed,
    coalesce(strlen(id) || ':' || id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM c),
leaf AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(changed) || ':' || changed, '-'))
    AS claimed, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS lo, count(*) OVER (PARTITION BY lang) AS size FROM t),
node AS (SELECT lang, 0 AS level, lo AS k, leaf AS digest, size AS width FROM leaf
  UNION ALL SELECT lang, level + 1, k // 8, sha256(string_agg(digest, '' ORDER BY k)), (width + 7) // 8 FROM node WHERE width > 1 GROUP BY lang, level, k // 8, width),
top AS (SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS size FROM node WHERE width = 1),
crown AS (SELECT 0 AS level, place AS k, subroot AS digest, size AS width FROM top
  UNION ALL SELECT level + 1, k // 8, sha256(string_agg(digest, '' ORDER BY k)), (width + 7) // 8 FROM crown WHERE width > 1 GROUP BY level, k // 8, width),
kin AS (SELECT lang, level, k, coalesce(string_agg(digest, '') OVER (PARTITION BY lang, level, k // 8 ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '') OVER (PARTITION BY lang, level, k // 8 ORDER BY k ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM node WHERE width > 1),
over_kin AS (SELECT level, k, coalesce(string_agg(digest, '') OVER (PARTITION BY level, k // 8 ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '') OVER (PARTITION BY level, k // 8 ORDER BY k ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM crown WHERE width > 1),
up AS (SELECT lang, lo, 0 AS level, lo AS k, claimed AS digest, '' AS proof, size AS width FROM leaf
  UNION ALL SELECT u.lang, u.lo, u.level + 1, u.k // 8, sha256(before || digest || after), proof || before || after, (u.width + 7) // 8
  FROM up u JOIN kin ON kin.lang IS NOT DISTINCT FROM u.lang AND kin.level = u.level AND kin.k = u.k WHERE u.width > 1),
on_top AS (SELECT u.lang, u.lo, 0 AS level, place AS k, digest, proof, size AS width FROM up u JOIN top ON top.lang IS NOT DISTINCT FROM u.lang WHERE u.width = 1
  UNION ALL SELECT u.lang, u.lo, u.level + 1, u.k // 8, sha256(before || digest || after), proof || before || after, (u.width + 7) // 8
  FROM on_top u JOIN over_kin o ON o.level = u.level AND o.k = u.k WHERE u.width > 1)
SELECT l.doc_id, l.leaf, top.subroot, r.digest AS root, sha256(o.proof) AS proof_sha256, o.digest AS folded_root, o.digest = r.digest AS verified
FROM leaf l JOIN on_top o ON o.lang IS NOT DISTINCT FROM l.lang AND o.lo = l.lo AND o.width = 1 JOIN top ON top.lang IS NOT DISTINCT FROM l.lang
JOIN crown r ON r.width = 1
""")
def op13_merkle_manifest(spark, table):
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", upper, lower))
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    made = merkle.manifest(table("documents"), fields, tampered=tampered)
    folded = made.withColumn("folded_root", merkle.fold(F.col("claimed"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))
