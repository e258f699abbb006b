"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_session_conf, ensure_checkpoint_dir
from ..sources.driver import read_driver_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Rows and bytes that Python tasks get at a time: texts may be long. (A text
#: beyond the bytes is a batch of its own.)
BATCH_ROWS, BATCH_BYTES = "1000", str(16 << 20)


def prepare(spark: SparkSession) -> None:
    apply_session_conf(spark)
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def escaped_sql(text: str) -> str:
    return rf"replace(replace(replace({text}, '\', '\\'), '### ', '\h## '), '</turn>', '\l/turn>')"


@register(
    "op1_chat_format",
    rf"""WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum(4 + length(replace({escaped_sql("role")}, ':', '\c')) + 2 + length({escaped_sql("text")}) + 8) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""",
)
def op1_chat_format(spark, sf_dir):
    """Every conversation, and conversation -7, folded from its event log,
    rendered, and read back from the formatted text."""
    from .chat import format_conversations, read_back

    probe = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    table = read_driver_table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return read_back(format_conversations(table.unionByName(own)))


@register(
    "op2_shingle_join",
    r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
k AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS component_id FROM documents UNION SELECT k.b, r.component_id FROM r JOIN k ON k.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id
JOIN (SELECT doc_id, min(component_id) AS component_id FROM r GROUP BY doc_id) c ON d.doc_id = c.doc_id""",
)
def op2_shingle_join(spark, sf_dir):
    """All documents linked at a Jaccard similarity of 0.8 on five words."""
    from .shingle_join import shingle_join

    return shingle_join(read_driver_table(spark, sf_dir, "documents"))


@register(
    "op4_warc",
    """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest,
  max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to FROM q""",
)
def op4_warc(spark, sf_dir):
    """A WARC record per page, written and read back by byte ranges."""
    from .warc import page_records

    return page_records(read_driver_table(spark, sf_dir, "pages"))


#: Rules of the URL query: fixed values.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
#: Pages with less html than this are stubs; their URLs are the list.
STUB_CHARS = 1000


def _rules_sql(what: str) -> str:
    cases = []
    for action, rule in sorted(URL_RULES, key=lambda r: -len(r[1])):
        top, slash, rest = rule.partition("/")
        cases.append(f"WHEN (host = '{top}' OR ends_with(host, '.{top}')) AND starts_with(path, '{slash}{rest}') THEN '{action if what == 'verdict' else rule}'")
    return "CASE " + " ".join(cases) + " END"


@register(
    "op6_url_filter",
    rf"""WITH r AS (SELECT page_id, html, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, html, url, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
n AS (SELECT *, CASE WHEN instr(url, '://') > 0 THEN regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') || regexp_replace(path, '(\.html?)?/*$', '') END AS name FROM h),
b AS (SELECT DISTINCT name FROM n WHERE length(html) < {STUB_CHARS} AND name IS NOT NULL)
SELECT page_id, host, path, {_rules_sql('rule')} AS rule,
  coalesce({_rules_sql('verdict')}, CASE WHEN b.name IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, b.name IS NOT NULL AS listed
FROM n LEFT JOIN b ON n.name = b.name""",
)
def op6_url_filter(spark, sf_dir):
    """Every page's URL judged by rules and, where none fits, by the list of
    the canonical URLs of stub pages."""
    from .url_filter import judge_urls

    pages = read_driver_table(spark, sf_dir, "pages")
    return judge_urls(pages, pages.where(F.char_length("html") < STUB_CHARS).select("url"), URL_RULES)


@register("op7_packing")
def op7_packing(spark, sf_dir):
    """All documents packed into sequences of at most 1024 ids."""
    import public_tokenizers

    from .packing import pack

    pieces = pack(read_driver_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@register("op8_sharding")
def op8_sharding(spark, sf_dir):
    """All documents in eight shards of near-equal bytes."""
    from .sharding import shard_documents

    return shard_documents(read_driver_table(spark, sf_dir, "documents"), 8)


@register("op9_quality_rules")
def op9_quality_rules(spark, sf_dir):
    """All documents judged by base rules and by robust distances."""
    from .quality import quality_rules

    return quality_rules(read_driver_table(spark, sf_dir, "documents")).drop("distance")


@register(
    "op10_substring_dedup",
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS span FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50) x),
g AS (SELECT span, min(doc_id) AS lo FROM s GROUP BY span HAVING min(doc_id) < max(doc_id)),
h AS (SELECT DISTINCT doc_id, i + j AS pos FROM (SELECT s.doc_id, s.i FROM s JOIN g ON s.span = g.span WHERE g.lo < s.doc_id) y, (SELECT unnest(range(0, 50)) AS j) z),
e AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM w WHERE len(words) > 0),
m AS (SELECT e.doc_id, count(*) AS n_words, count(h.pos) AS n_removed, string_agg(CASE WHEN h.pos IS NULL THEN e.word END, ' ' ORDER BY e.pos) AS kept FROM e LEFT JOIN h ON e.doc_id = h.doc_id AND e.pos = h.pos GROUP BY e.doc_id)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN m ON w.doc_id = m.doc_id""",
)
def op10_substring_dedup(spark, sf_dir):
    """All documents without the 50-word runs that smaller ids have too."""
    from .substrings import remove_repeats

    return remove_repeats(read_driver_table(spark, sf_dir, "documents"))


#: Target weights of the domains, in tokens: fixed values.
DOMAIN_WEIGHTS = {"good": 0.95, "low": 0.05, "toxic": 0.0}


@register("op5_source_mixing")
def op5_source_mixing(spark, sf_dir):
    """All documents with domain posteriors and rates that meet the weights."""
    from .mixing import mix

    return mix(read_driver_table(spark, sf_dir, "documents"), read_driver_table(spark, sf_dir, "labels"), DOMAIN_WEIGHTS)


#: Share of pairs just at the threshold that the vector query has to find.
VECTOR_RECALL = 0.99


@register("op3_vector_dedup")
def op3_vector_dedup(spark, sf_dir):
    """All embeddings linked at a cosine of 0.9, probing for ``VECTOR_RECALL``."""
    from .vectors import near_vectors

    return near_vectors(read_driver_table(spark, sf_dir, "embeddings"), recall=VECTOR_RECALL)


@register(
    "op11_line_dedup",
    r"""WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.pos, k.line, g.key IS NOT NULL AND k.doc_id <> g.top AS gone FROM k LEFT JOIN g ON k.key = g.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
)
def op11_line_dedup(spark, sf_dir):
    """All documents without the long lines that five documents or more hold,
    but for the largest of them; from keep bitmaps."""
    from .lines import line_bitmaps, line_digests

    docs = read_driver_table(spark, sf_dir, "documents")
    return line_digests(docs, line_bitmaps(docs))


@register(
    "op13_filter_audit",
    r"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT d.doc_id, part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
  100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
  d.doc_id > min(d.doc_id) OVER (PARTITION BY text) AS e, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
g AS (SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails,
  count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM x p, x q, x r, x s, x t
  WHERE p.x NOT IN (q.x, r.x, s.x, t.x) AND q.x NOT IN (r.x, s.x, t.x) AND r.x NOT IN (s.x, t.x) AND s.x <> t.x),
w AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
m AS (SELECT part, filter_order, step, x, n, good, toxic, fails, contains(fails, x) AS hit, length(translate(fails, before, '')) < length(fails) AS gone FROM g, w),
z AS (SELECT part, filter_order, step, x, CAST(sum(CASE WHEN gone OR hit THEN 0 ELSE n END) AS BIGINT) AS kept, CAST(sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant, CAST(sum(CASE WHEN fails = x THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost, CAST(sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM m GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM z""",
)
def op13_filter_audit(spark, sf_dir):
    """Five filters over all documents in all 120 orders, per source."""
    from .audit import filter_audit, judged

    return filter_audit(judged(read_driver_table(spark, sf_dir, "documents"), read_driver_table(spark, sf_dir, "labels")))


@register("op12_spelling_groups")
def op12_spelling_groups(spark, sf_dir):
    """All words of all documents with the frequent word that each may be a
    misspelling of. (The checksum that leaves letters out has no SQL.)"""
    from .spelling import spelling_groups

    return spelling_groups(read_driver_table(spark, sf_dir, "documents"))
