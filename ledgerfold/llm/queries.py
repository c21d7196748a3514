"""The registered queries of these operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm import (
    conversation_trie,
    filter_audit,
    language_id,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    simhash,
    suffix_dedup,
    token_counts,
    topk,
    toxicity,
    url_filters,
)
from ledgerfold.llm.common import fold
from ledgerfold.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

def tokenizer(name: str) -> str:
    """Where a public tokenizer's file is; operators take the path as a parameter."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 50-byte strings of earlier ones."""
    docs = table(spark, sf_dir, "documents")
    return suffix_dedup.remove_repeats(docs, keep_text=False).drop("spans")


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut into pieces of sequences of 4096 tokens, balanced by cost."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), end_id=2)


#: Fixed values of the query and its SQL.
MIX = mixing.Mix(
    domains={
        "web": (6, ("src0", "src1", "src2", "src3", "src4", "src5", "src6")),
        "reference": (3, ("src7", "src8", "src9", "src10", "src11", "src12")),
        "forum": (1, ("src13", "src14", "src15", "src16", "src17", "src18", "src19")),
    },
    languages={"en": 5, "de": 2, "fr": 2, "es": 1},
    sources={"src0": 3, "src7": 2},
    share=(3, 5),
    max_epochs=3,
)


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by epoch, three fifths of all words shared by domain, language, source."""
    chosen = mixing.mix_documents(table(spark, sf_dir, "documents"), MIX)
    columns = ["doc_id", "epoch", "domain", "lang", "source", "n_tokens"]
    return chosen.select(*columns).withColumn("epoch", F.col("epoch").cast("long"))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that vote on every document, weighed by expectation-maximisation."""
    judged = quality_rules.judged(table(spark, sf_dir, "documents"))
    return judged.drop("votes")


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors for every fiftieth vector."""
    vectors = topk.whole_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two of three folds."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = language_id.train(docs.where(~held_out))
    return _with_fold(language_id.identify(docs, model), held_out)


def _with_fold(scored: DataFrame, held_out: Column) -> DataFrame:
    first, *others = scored.columns
    return scored.select(first, held_out.alias("held_out"), *others)


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts through a digest cache that starts empty."""
    docs = table(spark, sf_dir, "documents")
    cache = fresh_path(spark, "token_counts")
    counts = token_counts.token_counts(docs, tokenizer("byte_bpe_50k.json"), cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from two of three folds."""
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    held_out = fold(F.col("doc_id"), 3) == 1
    grammar = toxicity.train(docs, labels.where(~held_out))
    scored = _with_fold(toxicity.score(docs, grammar), held_out)
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from four of five folds."""
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    held_out = fold(F.col("doc_id"), 5) == 0
    model = quality_classifier.train(docs, labels.where(~held_out))
    scored = _with_fold(quality_classifier.score(docs, model), held_out)
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of openings of all conversations, some openings put in for others."""
    conversations = table(spark, sf_dir, "conversations")
    turns, sizes = conversation_trie.ordered_turns(conversations)
    return conversation_trie.prefix_trie(conversation_trie.grafted(turns, sizes, 20, 4))


#: Fixed values of the query.
URL_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)


@query
def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL allowed or blocked, by a rule or else by what the rules' URLs show."""
    judged = url_filters.judge_rows(table(spark, sf_dir, "pages"), URL_RULES)
    columns = ["host", "path", "rule", "verdict", "score", "score_limit"]
    return judged.select(F.col("doc_id").alias("page_id"), *columns)


#: Fixed values of the query and its SQL: what fails, of a text and its words.
FILTERS: dict[str, filter_audit.Filter] = {
    "A": lambda text, words: F.size(words) < 200,
    "B": lambda text, words: F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
    "C": lambda text, words: F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * 2,
    "D": lambda text, words: F.rlike(text, F.lit("[#$%&*|]")),
}


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes at each step of all their orders, per source."""
    counters = filter_audit.audit(
        spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"), FILTERS
    )
    return filter_audit.orders_report(counters, "".join(FILTERS) + "E")


SQL: dict[str, str] = {}


def _case(column: str, values: dict[str, object], default: object) -> str:
    whens = " ".join(f"WHEN {column} = '{k}' THEN {v!r}" for k, v in values.items())
    return f"CASE {whens} ELSE {default!r} END"


def _share_sql(depth: int) -> str:
    """One level of the tree: the share of each child of each node."""
    path = mixing.PATH
    node, parent = ", ".join(path[: depth + 1]), ", ".join(path[:depth])
    group = f"PARTITION BY {parent}" if parent else ""
    order = f"ORDER BY CAST(cap AS DOUBLE) / NULLIF(weight, 0) NULLS LAST, {path[depth]}"
    given = (
        f"(SELECT (sum(tokens) * {MIX.share[0]}) // {MIX.share[1]} FROM leaves)"
        if not depth
        else "first(budget)"
    )
    source = f"level_{depth - 1}" if depth else "leaves"
    weights = (
        {d: w for d, (w, _) in MIX.domains.items()},
        dict(MIX.languages),
        dict(MIX.sources),
    )[depth]
    return f"""
children_{depth} AS (
  SELECT {node}, CAST(sum(room) AS BIGINT) AS cap, CAST({given} AS BIGINT) AS given,
         CAST({_case(path[depth], weights, 1)} AS BIGINT) AS weight
  FROM {source} GROUP BY {node}
), ranked_{depth} AS (
  SELECT *, cap * sum(weight) OVER ({group} {order}
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= (given - (sum(cap) OVER ({group} {order}
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cap)) * weight AS is_full
  FROM children_{depth}
), shared_{depth} AS (
  SELECT {node}, CAST(CASE WHEN is_full THEN cap ELSE
         ((given - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({group})) * weight)
         // sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({group}) END AS BIGINT) AS budget
  FROM ranked_{depth}
), level_{depth} AS (
  SELECT s.* {"EXCLUDE (budget)" if depth else ""}, budgets.budget
  FROM {source} s JOIN shared_{depth} budgets USING ({node})
)"""


def _mixing_sql() -> str:
    domains = {s: d for d, (_, sources) in MIX.domains.items() for s in sources}
    return f"""
WITH counted AS (
  SELECT doc_id, {_case("source", domains, "other")} AS domain, lang, source,
         CAST(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents
), leaves AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens,
         CAST(sum(n_tokens) * {MIX.max_epochs} AS BIGINT) AS room
  FROM counted GROUP BY ALL
), {", ".join(_share_sql(depth).strip() for depth in range(3))}, planned AS (
  SELECT domain, lang, source, CASE WHEN budget > 0 THEN budget // tokens ELSE 0 END AS whole,
         CASE WHEN budget = 0 OR budget = room THEN -1 ELSE budget % tokens END AS prefix
  FROM level_2
), placed AS (
  SELECT counted.*, whole, prefix, sum(n_tokens) OVER (
           PARTITION BY domain, lang, source
           ORDER BY md5(concat_ws('-', '{MIX.seed}', whole, doc_id))) AS until
  FROM counted JOIN planned USING (domain, lang, source)
)
SELECT doc_id, epoch, domain, lang, source, n_tokens
FROM (SELECT *, unnest(range(CASE WHEN until <= prefix THEN whole + 1 ELSE whole END)) AS epoch
      FROM placed)
"""


SQL["op3_mixing"] = _mixing_sql()

SQL["op6_topk"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
      FROM scored)
WHERE place <= 5
"""

SQL["op13_filter_audit"] = """
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), failing AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text)
                 THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 'E' ELSE '' END AS fails
  FROM texts
), flags AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), counters AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS n_good,
         coalesce(sum(toxic), 0) AS n_toxic
  FROM failing LEFT JOIN flags USING (doc_id) GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5
), steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, left(filter_order, step - 1) AS before,
         substr(filter_order, step, 1) AS letter
  FROM orders, range(1, 6) AS t(step)
), judged AS (
  SELECT part, filter_order, step, letter, n, n_good, n_toxic, contains(fails, letter) AS fails_it,
         translate(fails, before, '') <> fails AS gone,
         fails = letter AS only_it
  FROM counters, steps
), summed AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (NOT gone AND NOT fails_it), 0) AS kept,
         coalesce(sum(n) FILTER (NOT gone AND fails_it), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND fails_it), 0) AS redundant,
         coalesce(sum(n) FILTER (only_it), 0) AS unique_fails,
         coalesce(sum(n_good) FILTER (NOT gone AND fails_it), 0) AS good_lost,
         coalesce(sum(n_toxic) FILTER (NOT gone AND fails_it), 0) AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM summed
"""

SQL["op11_conversation_trie"] = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         md5(concat(length(coalesce(role, '')), ':', role, text)) AS item,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
           md5(concat(length(coalesce(role, '')), ':', role, text))) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  -- CRC-32 of the decimal id, bit by bit: each byte is added at the first of its eight steps.
  SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(
           list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
             string_split(CAST(conv_id AS VARCHAR), ''),
             lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
           lambda crc, b: xor(xor(crc, b) >> 1, 3988292384 * (xor(crc, b) & 1))),
         CAST(4294967295 AS BIGINT)) % 4 AS h
  FROM turns
), rebuilt AS (
  SELECT convs.conv_id, k, item, text FROM convs JOIN turns ON turns.conv_id = base AND k <= h
  UNION ALL
  SELECT convs.conv_id, k, item, text FROM convs JOIN turns USING (conv_id) WHERE k > h
), members AS (
  SELECT conv_id, CAST(row_number() OVER opening AS BIGINT) AS depth,
         string_agg(item, '') OVER opening AS node,
         CAST(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS words
  FROM rebuilt
  WINDOW opening AS (PARTITION BY conv_id ORDER BY k ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs
), ending AS (
  SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
  FROM (SELECT conv_id, max_by(node, depth) AS node FROM members GROUP BY conv_id) GROUP BY node
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(words) AS saved
  FROM members GROUP BY node, depth
), edges AS (
  SELECT nodes.node, members.node AS parent
  FROM nodes JOIN members ON members.conv_id = nodes.conv_id AND members.depth = nodes.depth - 1
), children AS (
  SELECT parent AS node, count(*) AS n_children FROM edges GROUP BY parent
), totals AS (
  SELECT members.node, CAST(sum(saved) AS BIGINT) AS saved_tokens,
         count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM nodes LEFT JOIN children USING (node)
  JOIN members ON members.conv_id = nodes.conv_id AND members.depth <= nodes.depth
  GROUP BY members.node
)
SELECT nodes.conv_id, nodes.depth, above.conv_id AS parent_conv_id, nodes.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
       coalesce(ends, sha256('')) AS ends_sha256
FROM nodes LEFT JOIN children USING (node) JOIN totals USING (node)
LEFT JOIN ending USING (node) LEFT JOIN edges USING (node)
LEFT JOIN nodes above ON above.node = edges.parent
"""
