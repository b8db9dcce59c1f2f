"""Queries of the operators: one per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


@_query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of documents through a digest cache that starts empty."""
    from . import encoding, token_counts

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), encoding.public("byte_bpe_50k.json"))


@_query("op2_decontamination", r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
         bw AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
         b AS (SELECT *, least(len(words), 10) AS size FROM bw WHERE len(words) > 0),
         bwin AS (SELECT DISTINCT item, size, array_to_string(words[i:i + size - 1], ' ') AS win
                  FROM (SELECT item, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM b)),
         dwin AS (SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS win
                  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
                        FROM w, (SELECT DISTINCT size FROM b) WHERE len(words) >= size)),
         hit AS (SELECT doc_id, i, dwin.size, item FROM dwin JOIN bwin ON dwin.win = bwin.win AND dwin.size = bwin.size),
         hw AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM hit) GROUP BY 1),
         hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
    SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM w LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in documents."""
    from . import decontaminate

    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


_JACCARD_SQL = f"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
         s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS sh
               FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM w WHERE len(words) > 0)),
         n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
         i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
         l AS (SELECT x, y FROM i JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y WHERE 100 * c >= 85 * (na.n + nb.n - c)),
         e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
         r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.other)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
    FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM r GROUP BY 1) m USING (doc_id)"""


@_query("op3_jaccard_join", _JACCARD_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by 4-word shingle Jaccard of at least 0.85."""
    from . import jaccard_join

    return jaccard_join.join_components(table(spark, sf_dir, "documents"))


@_query("op4_exact_dedup", f"""
    WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact deduplication of documents by Grace hashing."""
    from . import exact_dedup

    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


@_query("op9_warc_revisits", """
    WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                      sha256(coalesce(html, '')) AS payload_digest FROM pages),
         r AS (SELECT payload_digest AS d, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first_id <> page_id THEN first_id END AS refers_to
    FROM p LEFT JOIN r ON d = payload_digest""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives with revisit records, read back and resolved."""
    from . import warc

    out = warc.round_trip(table(spark, sf_dir, "pages"))
    return out.select(F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of at most 1024 tokens."""
    from . import encoding, packing

    return packing.pack(table(spark, sf_dir, "documents"), encoding.public("byte_bpe_50k.json"))


@_query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifier chain over the categories that ``labels`` has: junk, then toxic."""
    from . import toxicity

    docs = table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), {"junk": F.col("quality") == 0, "toxic": F.col("toxic") == 1})
    return toxicity.judge(docs, chain)


@_query("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak-label model over heuristic labellers, then the hashed scorer."""
    from . import quality

    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs))


def _license_sql() -> str:
    from .license_scan import LEAST, SHINGLE, TEMPLATES, TEXTS, template_words

    given = []
    for name, text in {**TEMPLATES, **TEXTS}.items():
        w = template_words(text)
        k = min(SHINGLE, len(w))
        given += [f"('{name}', {k}, {len(w) - k + 1}, '{' '.join(w[i:i + k])}')" for i in range(len(w) - k + 1)]
    return f"""
    WITH t(license, k, size, sh) AS (VALUES {", ".join(given)}),
         w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
         s AS (SELECT doc_id, k, i, len(words) - k + 1 AS n, array_to_string(words[i:i + k - 1], ' ') AS sh
               FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, (SELECT DISTINCT k FROM t) WHERE len(words) >= k)),
         h AS (SELECT DISTINCT s.doc_id, t.license, t.size, s.n, s.i, s.sh FROM s JOIN t ON t.k = s.k AND t.sh = s.sh),
         a AS (SELECT DISTINCT doc_id, license, size, unnest(range(least(greatest(1, i - size + 1), greatest(1, least(i, n - size + 1))), greatest(1, least(i, n - size + 1)) + 1)) AS start FROM h),
         c AS (SELECT a.doc_id, a.license, a.start, count(DISTINCT h.sh) AS n FROM a JOIN h ON h.doc_id = a.doc_id AND h.license = a.license AND h.i >= a.start AND h.i < a.start + a.size GROUP BY ALL),
         x AS (SELECT doc_id, c.license, start, c.n / tt.n AS containment FROM c JOIN (SELECT license, count(DISTINCT sh) AS n FROM t GROUP BY 1) tt ON tt.license = c.license)
    SELECT doc_id, license, max(containment) AS containment, CAST(arg_min(start, (-containment, start)) - 1 AS BIGINT) AS first_word
    FROM x WHERE containment >= {LEAST} GROUP BY 1, 2"""


@_query("op8_license_scan", _license_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License statements in documents."""
    from . import license_scan

    return license_scan.scan(table(spark, sf_dir, "documents"))


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


@_query("op10_url_filter")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, then gradient-boosted trees, over every page's URL."""
    from . import url_filter

    return url_filter.judge(table(spark, sf_dir, "pages"), RULES).drop("model")


_TRIE_SQL = r"""
    WITH o AS (SELECT conv_id AS c, text AS t, token, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, token) AS p
               FROM (SELECT conv_id, turn, coalesce(text, '') AS text, sha256(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, ''))) AS token
                     FROM conversations WHERE conv_id IS NOT NULL)),
         e AS (SELECT c, count(*) AS n, c - c % 20 AS b,
                      xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                                      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 AS h
               FROM o GROUP BY c),
         k AS (SELECT e.*, least(e.h, coalesce(x.n, 0)) AS k FROM e LEFT JOIN e x ON x.c = e.b),
         turns AS (SELECT k.c, o.p AS d, t, token FROM k JOIN o ON o.c = k.b AND o.p <= k.k
                   UNION ALL SELECT k.c, k.k + o.p - k.h, t, token FROM k JOIN o ON o.c = k.c AND o.p > k.h),
         paths AS (SELECT k.c, coalesce(a, []) AS a FROM k LEFT JOIN (SELECT c, list(token ORDER BY d) AS a FROM turns GROUP BY c) USING (c)),
         mem AS (SELECT c, d, len(a) AS n, md5(array_to_string(a[1:d], '')) AS node, CASE WHEN d > 0 THEN md5(array_to_string(a[1:d - 1], '')) END AS parent
                 FROM (SELECT c, a, unnest(range(0, len(a) + 1)) AS d FROM paths)),
         node AS (SELECT node, d, min(parent) AS parent, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
                  FROM mem GROUP BY node, d),
         w AS (SELECT DISTINCT node, len(regexp_extract_all(t, '[^ 	-]+')) AS words FROM mem JOIN turns USING (c, d)),
         kids AS (SELECT parent AS node, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY 1),
         anc AS (SELECT DISTINCT m.node, x.node AS above FROM mem m JOIN mem x ON x.c = m.c AND x.d <= m.d),
         sub AS (SELECT above AS node, sum((n_convs - 1) * coalesce(words, 0)) AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
                 FROM anc JOIN node USING (node) LEFT JOIN w USING (node) LEFT JOIN kids USING (node) GROUP BY 1)
    SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
           CAST(saved_tokens AS BIGINT) AS saved_tokens, node.ends_sha256
    FROM node JOIN sub USING (node) LEFT JOIN kids USING (node) LEFT JOIN node up ON up.node = node.parent"""


@_query("op11_conversation_trie", _TRIE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations."""
    from . import conversation_trie

    nodes = conversation_trie.trie(conversation_trie.rebuilt(table(spark, sf_dir, "conversations")))
    names = {"conv": "conv_id", "depth": "depth", "parent_conv": "parent_conv_id", "n": "n_convs", "children": "n_children", "leaves": "n_leaves", "saved": "saved_tokens", "ends_sha256": "ends_sha256"}
    return nodes.select(*[F.col(a).alias(b) for a, b in names.items()])


@_query("op12_mixing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed by source, in blocks, to weights 1, 2, 3, repeating."""
    from . import mixing

    return mixing.mix(table(spark, sf_dir, "documents")).taken().withColumnRenamed("id", "doc_id")


@_query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings on the 16 leading components of their covariance."""
    from . import whitening

    out = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").cast("long"))
