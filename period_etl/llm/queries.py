"""Registered queries of the operators: whole tables in, the contracts' columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from period_etl.llm.binpack import assign_shards
from period_etl.llm.bloom_lm import score_documents
from period_etl.llm.bpe import bpe_digest
from period_etl.llm.common import table
from period_etl.llm.decontam import leaks
from period_etl.llm.html_text import extract_pages
from period_etl.llm.licenses import LEAST_CLASS, K, known_licenses, known_texts, license_scan
from period_etl.llm.merkle import build, document_leaves, verify
from period_etl.llm.near_dup import near_duplicates
from period_etl.llm.packing import pack_documents
from period_etl.llm.quality import fit_line_field, quality_rules
from period_etl.llm.ranked import ranked_search
from period_etl.llm.rans import read_token_files, write_token_files
from period_etl.llm.warc import build_derivatives, page_responses
from period_etl.session import scratch_dir

#: ASCII-folded words of a text as a DuckDB list; null and empty texts have none.
_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x20\\x09-\\x0D]+')")


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_derivatives(page_responses(table(spark, sf_dir, "pages"), "2024-01-01T00:00:00Z"))


def op2_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = fit_line_field(docs, table(spark, sf_dir, "labels"))
    return quality_rules(docs, field).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                             "base_failed", "kept", "content_words")


#: Tokenizer files: the public vocabularies of this machine. Other places set the operators' path parameter.
def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), out, tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return read_token_files(spark, out, as_ids=False)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"), shards=40)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digest(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"), known_licenses(spark))
    return found.select("doc_id", "license", "start", "n_words", "common", "total")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "n_words", "common", "whole")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = build(document_leaves(table(spark, sf_dir, "documents")), "lang", "doc_id", "leaf")
    return verify(made, "claim").select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2, capacity=1024)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def _grams(words: str, k: int) -> str:
    """SQL for (doc_id, m, pos, g): the k-word shingles of each document; ``words`` makes its m words from ``text``."""
    rest = "".join(f", lead(x, {i}) OVER o" for i in range(1, k))
    return (f"SELECT doc_id, m, pos, g FROM (SELECT doc_id, m, pos, CASE WHEN m <= {k} THEN whole ELSE concat_ws(' ', x{rest}) END AS g "
            f"FROM (SELECT doc_id, len(w) AS m, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS pos, "
            f"CASE WHEN len(w) <= {k} THEN array_to_string(w, ' ') END AS whole FROM (SELECT doc_id, {words} AS w FROM documents)) "
            f"WINDOW o AS (PARTITION BY doc_id ORDER BY pos)) WHERE pos <= greatest(m - {k}, 0)")


_OP5 = f"""
WITH RECURSIVE s AS (SELECT DISTINCT doc_id, g FROM ({_grams(_WORDS, 4)})),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.c),
m AS (SELECT id, min(c) AS c FROM r GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, doc_id = m.c AS kept
FROM documents JOIN m ON m.id = doc_id LEFT JOIN n USING (doc_id)
"""

_VALUES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in known_texts().items())
_ALNUM = "regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+')"


def _shingled(words: str, k: int) -> str:
    """The k-word shingles of a list of words, joined by spaces."""
    return (f"CASE WHEN len({words}) = 0 THEN [] WHEN len({words}) <= {k} THEN [array_to_string({words}, ' ')] "
            f"ELSE list_transform(range(1, len({words}) - {k - 2}), lambda i: array_to_string({words}[i:i + {k - 1}], ' ')) END")


_OP9 = f"""
WITH t AS (SELECT license, w, greatest({LEAST_CLASS}, 2 ** ceil(log2(len(w))))::BIGINT AS c
           FROM (SELECT license, {_ALNUM} AS w FROM (VALUES {_VALUES}) v(license, text))),
ts AS (SELECT license, c, unnest(list_distinct({_shingled('w', K)})) AS g FROM t),
n AS (SELECT license, count(*) AS total FROM ts GROUP BY 1),
s AS ({_grams(_ALNUM, K)}),
a AS (SELECT doc_id, m, license, c, g, pos, unnest([pos // c * c, pos // c * c - c]) AS start FROM s JOIN ts USING (g)),
h AS (SELECT doc_id, license, start, least(2 * c, m - start) AS n_words, count(DISTINCT g) AS common FROM a
      WHERE start >= 0 AND pos + {K} <= start + 2 * c GROUP BY ALL)
SELECT doc_id, license, start, n_words, common, total FROM h JOIN n USING (license) WHERE common * 100 >= total * 80
QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY common DESC, start) = 1
"""

_OP10 = f"""
WITH i AS (SELECT item_id, w, len(w) AS n_words, {_shingled('w', 5)} AS gs FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
ig AS (SELECT item_id, n_words, unnest(gs) AS g, generate_subscripts(gs, 1) - 1 AS o FROM i),
s AS ({_grams(_WORDS, 5)}),
v AS (SELECT DISTINCT doc_id, item_id, n_words, pos - o AS start FROM s JOIN ig USING (g) WHERE pos >= o AND pos - o + n_words <= m),
mine AS (SELECT v.doc_id, item_id, v.start, n_words, s.g, count(*) AS x FROM v JOIN s ON s.doc_id = v.doc_id
         AND s.pos BETWEEN v.start AND v.start + greatest(n_words - 5, 0) GROUP BY ALL),
its AS (SELECT item_id, g, count(*) AS y FROM ig GROUP BY ALL),
c AS (SELECT doc_id, item_id, start, n_words, sum(least(x, coalesce(y, 0)))::BIGINT AS common FROM mine LEFT JOIN its USING (item_id, g) GROUP BY ALL),
u AS (SELECT *, 2 * greatest(n_words - 4, 1) - common AS whole FROM c)
SELECT doc_id, item_id, start, n_words, common, whole FROM u WHERE common * 100 >= whole * 80
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY common / whole DESC, start) = 1
"""

def _leaf(more: int) -> str:
    """The leaf of a document with ``more`` added to n_chars."""
    fields = ("doc_id", "source", "lang", f"n_chars + {more}" if more else "n_chars", "text")
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields) + ")"


#: CRC-32 of the decimal doc_id, one byte and then one bit at a time.
_CRC = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)), "
        "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda r, i: xor(r >> 1, (r & 1) * 3988292384))))")
_HEIGHT = "ceil(log2(count(*) OVER (PARTITION BY {}))) ::BIGINT"

_OP11 = f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, {_leaf(0)} AS leaf, CASE WHEN {_CRC} % 7 = 0 THEN {_leaf(1)} ELSE {_leaf(0)} END AS claim FROM documents),
g AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT lang FROM d)),
l AS (SELECT d.*, g, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS i, {_HEIGHT.format('g')} AS height
      FROM d JOIN g ON d.lang IS NOT DISTINCT FROM g.lang),
t AS (SELECT g, height, 0::BIGINT AS level, i, leaf AS h FROM l
      UNION ALL SELECT g, height, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE level < height GROUP BY g, height, level, i // 2),
s AS (SELECT g, h AS subroot, {_HEIGHT.format('1')} AS height FROM t WHERE level = height),
u AS (SELECT height, 0::BIGINT AS level, g AS i, subroot AS h FROM s
      UNION ALL SELECT height, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE level < height GROUP BY height, level, i // 2),
n AS (SELECT g, level, i, h FROM t WHERE level < height UNION ALL SELECT -1, level, i, h FROM u WHERE level < height),
steps AS (SELECT doc_id, leaf, l.g, i, level, g AS tree, (i >> level::INT) AS place, level AS step FROM l, unnest(range(height)) x(level)
          UNION ALL SELECT doc_id, leaf, l.g, i, level, -1, (l.g >> level::INT), l.height + level FROM l JOIN s USING (g), unnest(range(s.height)) x(level)),
p AS (SELECT steps.doc_id, steps.leaf, steps.g, steps.i, step, place, n.h AS other FROM steps
      LEFT JOIN n ON n.g = tree AND n.level = steps.level AND n.i = xor(place, 1)),
q AS (SELECT g, i, max(step) + 1 AS steps, coalesce(string_agg(other, '' ORDER BY step), '') AS proof FROM p GROUP BY g, i),
f AS (SELECT g, i, 0::BIGINT AS step, claim AS h FROM l
      UNION ALL SELECT f.g, f.i, f.step + 1, sha256(CASE WHEN other IS NULL THEN h WHEN place & 1 = 1 THEN other || h ELSE h || other END)
      FROM f JOIN p ON p.g = f.g AND p.i = f.i AND p.step = f.step)
SELECT l.doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM l JOIN s USING (g), (SELECT h AS root FROM u WHERE level = height) LEFT JOIN q ON q.g = l.g AND q.i = l.i
JOIN f ON f.g = l.g AND f.i = l.i AND f.step = coalesce(q.steps, 0)
"""

_TERMS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")

_OP13 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS ts FROM documents),
a AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS total FROM d WHERE len(ts) > 0),
x AS (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS t FROM d),
f AS (SELECT r, doc_id, n, t, count(*) AS tf FROM x GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, a GROUP BY t, n_docs),
i AS (SELECT DISTINCT item_id, q, unnest(ts) AS t FROM (SELECT item_id, row_number() OVER () AS q, {_TERMS} AS ts FROM benchmark)),
s AS (SELECT item_id, q, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // total)))))::BIGINT AS score
      FROM i JOIN f USING (t) JOIN w USING (t), a GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST)::INT AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_derivatives": op1_warc_derivatives,
    "op2_bloom_lm": op2_bloom_lm,
    "op3_quality": op3_quality,
    "op4_token_files": op4_token_files,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_shards": op6_shards,
    "op7_bpe": op7_bpe,
    "op8_main_text": op8_main_text,
    "op9_licenses": op9_licenses,
    "op10_decontamination": op10_decontamination,
    "op11_merkle": op11_merkle,
    "op12_packing": op12_packing,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE_SQL: dict[str, str] = {
    "op5_near_duplicates": _OP5,
    "op9_licenses": _OP9,
    "op10_decontamination": _OP10,
    "op11_merkle": _OP11,
    "op13_ranked_search": _OP13,
}
