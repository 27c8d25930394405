"""The registered queries over documents, pages and vectors, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlgrid.llm import (
    bpe,
    html_text,
    language,
    minhash,
    mixing,
    quality,
    repeats,
    spelling,
    topk,
    toxicity,
    url_rules,
    vectors,
    whitening,
)

# The prefix rules that the query is asked to apply.
PREFIX_RULES = [
    url_rules.prefix_rule("allow", "org", "/"),
    url_rules.prefix_rule("block", "example.org", "/es/"),
    url_rules.prefix_rule("block", "example.org", "/en/1"),
    url_rules.prefix_rule("allow", "com", "/fr/"),
    url_rules.prefix_rule("block", "com", "/de/"),
]

# Hosts of spam and advertising, and pages that are no articles: forms, listings, feeds.
PATTERN_RULES = [
    url_rules.pattern_rule(text)
    for text in [
        "||ads.",
        "||ads-",
        "||adult-",
        "||casino-",
        "||spam-",
        "||*-bets.",
        "||*-pills.",
        "||doubleclick.net^",
        "/login^",
        "/signup^",
        "/cart^",
        "/checkout^",
        "/wp-admin^",
        "/search?",
        "?page=*&ref=",
        "/feed.xml|",
        "/casino^",
        "/print^",
        "&print=1",
        "@@||docs.*/search?",
        "@@/en/*?page=",
    ]
]


# The mixture: four domains of sources, a main language, all sources alike.
MIXTURE = [
    mixing.Level("domain", {"domain0": 4.0, "domain1": 3.0, "domain2": 2.0}),
    mixing.Level("lang", {"en": 5.0, "fr": 2.0, "de": 2.0}),
    mixing.Level("source", {}),
]
MIXTURE_SHARE, MIXTURE_EPOCHS, MIXTURE_SEED = 0.8, 2, 20

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table; the path may be a file or a folder of files."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from the documents that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    # A null doc_id has no remainder, so it is not learned from.
    model = language.learn(docs, "doc_id", ~held_out)
    docs = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    return language.identify(docs, model)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's evidence, the shares of its source and language, and its posterior."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    rated = quality_rated(spark, docs, sf_dir, keep=["doc_id"])
    return rated.withColumn("kept", ~F.col("rejected")).drop("rejected")


def quality_rated(
    spark: SparkSession,
    docs: DataFrame,
    sf_dir: str,
    prefix: str = "",
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with the columns of ``quality.rate``; sources are hosts, languages their paths."""
    model = quality.learn(
        read(spark, sf_dir, "documents"),
        read(spark, sf_dir, "labels"),
        F.col("quality") == 1,
        "doc_id",
    )
    return quality.rate(docs, model, "source", "lang", prefix=prefix, keep=keep)


def op3_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links and component at a cosine of 0.9 and more."""
    return vectors.near_vectors(read(spark, sf_dir, "embeddings"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text, by weights learned from a sample of pages with an article element."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, weights=html_text.learn(pages, "page_id"))


def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mixture takes every document."""
    docs = mixture_columns(read(spark, sf_dir, "documents").drop("n_chars"))
    return mixed(docs.drop("text")).select(
        "doc_id",
        F.col("_domain").alias("domain"),
        "lang",
        "source",
        F.col("_tokens").alias("n_tokens"),
        F.col("_copies").alias("copies"),
    )


def mixture_columns(docs: DataFrame, prefix: str = "_") -> DataFrame:
    """Adds ``domain``, the domain of a document's source, and ``tokens``, its words, with ``prefix``."""
    digest = F.md5(F.coalesce("source", F.lit("")).cast("binary"))
    number = F.conv(F.substring(digest, 1, 4), 16, 10).cast("bigint") % 4
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^ \t-\r]+")), F.lit(0))
    return docs.withColumns(
        {
            f"{prefix}domain": F.concat(F.lit("domain"), number),
            f"{prefix}tokens": words.cast("bigint"),
        }
    )


def mixed(docs: DataFrame, prefix: str = "_") -> DataFrame:
    """``docs`` of ``mixture_columns`` with ``copies``, with ``prefix``."""
    return mixing.mix(
        docs,
        [MIXTURE[0]._replace(column=f"{prefix}domain"), *MIXTURE[1:]],
        MIXTURE_SHARE,
        MIXTURE_EPOCHS,
        MIXTURE_SEED,
        tokens=f"{prefix}tokens",
        copies=f"{prefix}copies",
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text decoded from them."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = bpe.encode(docs, VOCABULARY, decoded="decoded")
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability of each labelled category, and whether it is toxic."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rated = toxicity_rated(spark, docs, sf_dir).withColumnRenamed("rejected", "toxic")
    return rated.withColumn("kept", ~F.col("toxic")).drop("text")


def toxicity_rated(
    spark: SparkSession, docs: DataFrame, sf_dir: str, prefix: str = ""
) -> DataFrame:
    """``docs`` with the columns of ``toxicity.rate``."""
    categories = {"poor": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    chain = toxicity.learn(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), categories, "doc_id"
    )
    return toxicity.rate(docs, chain, prefix=prefix)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class among texts of a similarity of 0.8 and more."""
    return minhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, prefix rule and verdict."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_rules.judge_urls(pages, PREFIX_RULES, PATTERN_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "pattern")


def op10_repeat_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's repeats, base rules and verdict."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.repeat_rules(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "covered_words",
        "longest_repeat",
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents, with its near words' number, its form and its root."""
    return spelling.variants(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's coordinates in the leading components, at unit variance."""
    rows = whitening.whiten(read(spark, sf_dir, "embeddings"))
    # Null where the exact number has no bigint, which takes millions of vectors.
    return rows.withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op13_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 vectors of the highest score for every vector whose id is divisible by 20."""
    return topk.top_products(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


TOP_PRODUCTS_SQL = """
    WITH scaled AS (
        SELECT vec_id, list_transform(embedding, lambda c: floor(64 * CAST(c AS DOUBLE))) AS x
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    ), scores AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
        FROM scaled q JOIN scaled c ON q.vec_id <> c.vec_id
        WHERE q.vec_id % 20 = 0
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
        FROM scores
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def _spelling_sql() -> str:
    upper, lower = url_rules.UPPER, url_rules.LOWER
    fewest = spelling.LEAST_CHARS
    return f"""
        WITH RECURSIVE table_of AS (
            SELECT list(c ORDER BY b) AS crc
            FROM (SELECT b, list_reduce(list_concat([b], range(8)), lambda c, i:
                             CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
                  FROM range(256) bytes(b))
        ), runs AS (
            SELECT doc_id, run, count(*) AS c
            FROM (SELECT doc_id, unnest(regexp_extract_all(
                             translate(text, '{upper}', '{lower}'), '[a-zÀ-ÿ]{{{fewest},}}')) AS run
                  FROM documents)
            GROUP BY ALL
        ), bytes AS (
            SELECT run, c, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h
            FROM runs
        ), sums AS (
            SELECT run, c, xor(4294967295, list_reduce(
                       list_concat([4294967295], list_transform(range(length(h) // 2),
                           lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
                       lambda a, b: xor(a >> 8, crc[1 + (xor(a, b) & 255)]))) AS h
            FROM bytes, table_of
        ), words AS (
            SELECT word, CAST(sum(c) AS BIGINT) AS n
            FROM (SELECT CASE WHEN h % {spelling.DAMAGED} = 0
                              THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                              ELSE run END AS word, c
                  FROM sums)
            WHERE length(word) >= {fewest} GROUP BY word HAVING sum(c) >= {spelling.LEAST_COUNT}
        ), cut AS (
            SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
        ), pairs AS (
            SELECT a.word, b.word AS other, b.n
            FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION
            SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
            UNION
            SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word
        ), best AS (
            SELECT word, count(*) AS n_near,
                   arg_min(other, struct_pack(m := -n, o := other)) AS other, max(n) AS other_n
            FROM pairs GROUP BY word
        ), formed AS (
            SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
                   CASE WHEN b.other_n >= {spelling.FORM_FACTOR} * w.n THEN b.other END AS form,
                   CASE WHEN b.other_n >= {spelling.FORM_FACTOR} * w.n THEN b.other_n END AS form_n
            FROM words w LEFT JOIN best b ON w.word = b.word
        ), led AS (
            SELECT word, word AS root, 0 AS steps FROM formed
            UNION ALL
            SELECT l.word, f.form, steps + 1
            FROM led l JOIN formed f ON l.root = f.word WHERE f.form IS NOT NULL
        )
        SELECT f.word, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form,
               CAST(f.form_n AS BIGINT) AS form_n, l.root
        FROM formed f JOIN (SELECT word, arg_max(root, steps) AS root FROM led GROUP BY word) l
            ON f.word = l.word
    """


# The patterns once more, as expressions written by hand, so that SQL checks how they are read.
START, STOP = r"^([^/?#]*\.)?", "([^A-Za-z0-9_.%-]|$)"
PATTERN_SQL = {
    "||ads.": START + r"ads\.",
    "||ads-": START + "ads-",
    "||adult-": START + "adult-",
    "||casino-": START + "casino-",
    "||spam-": START + "spam-",
    "||*-bets.": START + r".*-bets\.",
    "||*-pills.": START + r".*-pills\.",
    "||doubleclick.net^": START + r"doubleclick\.net" + STOP,
    "/login^": "/login" + STOP,
    "/signup^": "/signup" + STOP,
    "/cart^": "/cart" + STOP,
    "/checkout^": "/checkout" + STOP,
    "/wp-admin^": "/wp-admin" + STOP,
    "/search?": r"/search\?",
    "?page=*&ref=": r"\?page=.*&ref=",
    "/feed.xml|": r"/feed\.xml$",
    "/casino^": "/casino" + STOP,
    "/print^": "/print" + STOP,
    "&print=1": "&print=1",
    "@@||docs.*/search?": START + r"docs\..*/search\?",
    "@@/en/*?page=": r"/en/.*\?page=",
}


def _url_sql() -> str:
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    patterns = ", ".join(
        f"({quote(text)}, {quote('allow' if text[:2] == '@@' else 'block')}, {quote('(?s)' + regex)})"
        for text, regex in PATTERN_SQL.items()
    )
    return f"""
        WITH cut AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0
                                 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{url_rules.UPPER}',
                                      '{url_rules.LOWER}') AS host,
                   substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) AS tail
            FROM cut
        ), prefixes(action, of_host, of_path) AS (VALUES
            ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
            ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
        ), patterns(text, action, regex) AS (VALUES {patterns}
        ), urls AS (
            SELECT DISTINCT host, tail, regexp_extract(tail, '^[^?#]*') AS path FROM parts
        ), longest AS (
            SELECT host, tail, arg_max(of_host || of_path, length(of_host || of_path)) AS rule,
                   arg_max(action, length(of_host || of_path)) AS action
            FROM urls, prefixes
            WHERE (host = of_host OR ends_with(host, '.' || of_host)) AND starts_with(path, of_path)
            GROUP BY host, tail
        ), found AS (
            SELECT host, tail, min(text) FILTER (action = 'allow') AS exception,
                   min(text) FILTER (action = 'block') AS block
            FROM urls, patterns WHERE regexp_matches(host || tail, regex)
            GROUP BY host, tail
        )
        SELECT p.page_id, p.host, regexp_extract(p.tail, '^[^?#]*') AS path, l.rule,
               coalesce(l.action, CASE WHEN f.block IS NOT NULL AND f.exception IS NULL
                                       THEN 'block' ELSE 'allow' END) AS verdict,
               CASE WHEN l.rule IS NULL THEN coalesce(f.exception, f.block) END AS pattern
        FROM parts p
        LEFT JOIN longest l ON p.host = l.host AND p.tail = l.tail
        LEFT JOIN found f ON p.host = f.host AND p.tail = f.tail
    """


def _mixture_sql() -> str:
    names = ["domain", "lang", "source"]
    steps = []
    for depth, level in enumerate(MIXTURE):
        path, family = names[: depth + 1], names[:depth]
        cases = " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in level.weights.items())
        weight = f"CASE {names[depth]} {cases} ELSE {level.other}::DOUBLE END"
        weight = weight if cases else f"{level.other}::DOUBLE"
        given = f"least({MIXTURE_SHARE}::DOUBLE * sum(held) OVER (), sum(room) OVER ())"
        joined = ""
        if family:
            given = "b.budget"
            same = " AND ".join(f"o.{c} IS NOT DISTINCT FROM b.{c}" for c in family)
            joined = f"JOIN budget{depth - 1} b ON {same}"
        part = "PARTITION BY " + ", ".join(family) if family else ""
        steps.append(f"""
            own{depth} AS (
                SELECT {", ".join(path)}, sum(held) AS held,
                       sum(held)::DOUBLE * {MIXTURE_EPOCHS} AS room, {weight} AS weight
                FROM leaves GROUP BY {", ".join(path)}
            ), given{depth} AS (
                SELECT o.*, {given} AS given FROM own{depth} o {joined}
            ), filled{depth} AS (
                SELECT *, (given - coalesce(sum(room) OVER before, 0))
                    / (sum(weight) OVER family - coalesce(sum(weight) OVER before, 0)) AS fill
                FROM given{depth}
                WINDOW family AS ({part}),
                       before AS ({part} ORDER BY room / weight, {names[depth]} NULLS FIRST
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            ), budget{depth} AS (
                SELECT {", ".join(path)},
                       greatest(least(room, weight * max(fill) OVER ({part})), 0) AS budget
                FROM filled{depth}
            )""")
    same = " AND ".join(f"l.{c} IS NOT DISTINCT FROM b.{c}" for c in names)
    leaf = " AND ".join(f"d.{c} IS NOT DISTINCT FROM p.{c}" for c in names)
    return f"""
        WITH docs AS (
            SELECT doc_id, lang, source,
                   'domain' || ('0x' || substr(md5(coalesce(source, '')), 1, 4))::BIGINT % 4
                       AS domain,
                   coalesce(len(regexp_extract_all(text, '[^ \\t-\\r]+')), 0)::BIGINT AS n_tokens
            FROM documents
        ), leaves AS (
            SELECT domain, lang, source, sum(n_tokens)::BIGINT AS held FROM docs GROUP BY ALL
        ), {",".join(steps)}, whole AS (
            SELECT l.*, floor(b.budget + 1e-6)::BIGINT AS whole
            FROM leaves l JOIN budget2 b ON {same}
        ), plans AS (
            SELECT *, CASE WHEN held > 0 THEN floor(whole / held)::BIGINT ELSE 0 END AS passes
            FROM whole
        ), ordered AS (
            SELECT d.*, p.passes, p.whole - p.passes * p.held AS rest,
                   sum(n_tokens) OVER (
                       PARTITION BY d.domain, d.lang, d.source
                       ORDER BY substr(md5(concat_ws(':', {MIXTURE_SEED}, p.passes, doc_id)), 1, 10),
                                doc_id
                       ROWS UNBOUNDED PRECEDING) AS so_far
            FROM docs d JOIN plans p ON {leaf}
        )
        SELECT doc_id, domain, lang, source, n_tokens,
               (passes + CASE WHEN so_far <= rest AND rest > 0 THEN 1 ELSE 0 END)::BIGINT AS copies
        FROM ordered
    """


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [op1_language, op2_quality, op3_near_vectors, op4_html_text, op5_mixture, op6_bpe, op7_toxicity, op8_near_duplicates, op9_url_rules, op10_repeat_rules, op11_spelling, op12_whitening, op13_top_products]

SQL: dict[str, str] = {
    "op5_mixture": _mixture_sql(),
    "op9_url_rules": _url_sql(),
    "op11_spelling": _spelling_sql(),
    "op13_top_products": TOP_PRODUCTS_SQL,
}
