"""The numbered queries over the given tables, and their SQL counterparts for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Lower-cases A-Z only, as the queries ask for.
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED_WORDS = f"list_filter(regexp_split_to_array({LOWERED}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


@query(
    "op10_near_duplicates",
    f"""
    WITH RECURSIVE words AS (SELECT doc_id, {SPACED_WORDS} AS w FROM documents),
    runs AS (
        SELECT DISTINCT doc_id, unnest(CASE
            WHEN len(w) = 0 THEN []::VARCHAR[]
            WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        END) AS run FROM words
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id),
    shared AS (
        SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS both_have
        FROM runs l JOIN runs r ON l.run = r.run AND l.doc_id <> r.doc_id GROUP BY l.doc_id, r.doc_id
    ),
    links AS (
        SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * both_have >= 85 * (x.n + y.n - both_have)
    ),
    reached AS (
        SELECT doc_id, doc_id AS other FROM documents
        UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other
    ),
    classes AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM classes LEFT JOIN sizes USING (doc_id)
    """,
)
def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    from .neardup import near_duplicates

    found = near_duplicates(table(spark, folder, "documents"), width=3, similarity=0.85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op9_pack_mixture")
def op9_pack_mixture(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    return pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_fingerprint_edits")
def op8_fingerprint_edits(spark: SparkSession, folder: str) -> DataFrame:
    from .fingerprint import fingerprints_of_edits

    return fingerprints_of_edits(table(spark, folder, "documents"))


_ALNUM_WORDS = f"list_filter(regexp_split_to_array({LOWERED}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
_FIVE_WORDS = (
    "CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] "
    "ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END"
)


@query(
    "op3_benchmark_leaks",
    f"""
    WITH document_words AS (SELECT doc_id, {_ALNUM_WORDS} AS w FROM documents),
    item_words AS (SELECT item_id, {_ALNUM_WORDS} AS w FROM benchmark),
    item_runs AS (SELECT DISTINCT item_id, unnest({_FIVE_WORDS}) AS run FROM item_words),
    sizes AS (SELECT item_id, count(*) AS n_item FROM item_runs GROUP BY item_id),
    document_runs AS (SELECT DISTINCT doc_id, unnest({_FIVE_WORDS}) AS run FROM document_words),
    shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM item_runs JOIN document_runs USING (run) GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
    FROM shared JOIN sizes USING (item_id) WHERE n_shared * 5 >= n_item * 4
    """,
)
def op3_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    from .decontaminate import contained_items

    found = contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "n_item", "n_shared", "containment")


@query("op2_disclosing_terms")
def op2_disclosing_terms(spark: SparkSession, folder: str) -> DataFrame:
    from .pii import ENTITIES, spans_of

    found = spans_of(table(spark, folder, "documents"))
    return found.select("doc_id", *[f"n_{k}" for k in ENTITIES], "n_added", "base_sha256", "spans")


@query("op5_language_field")
def op5_language_field(spark: SparkSession, folder: str) -> DataFrame:
    from .language import predict, train
    from .tables import held_out

    docs = table(spark, folder, "documents")
    found = predict(docs, train(docs))
    return found.select("doc_id", held_out(5).alias("held_out"), "lang_pred", "score")


@query("op6_context_tree")
def op6_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    from .contexttree import scored
    from .tables import held_out

    found = scored(table(spark, folder, "documents"))
    columns = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return found.select("doc_id", held_out(10).alias("held_out"), *columns)


@query("op4_toxicity_pu")
def op4_toxicity_pu(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .tables import held_out
    from .toxicity import predict, train

    docs = table(spark, folder, "documents")
    found = predict(docs, train(docs, table(spark, folder, "labels")))
    return found.select(
        "doc_id", held_out(5).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


@query("op1_license_index")
def op1_license_index(spark: SparkSession, folder: str) -> DataFrame:
    from .licenses import scanned

    return scanned(table(spark, folder, "documents"))


def _chat_sql() -> str:
    from .chat import ASSISTANT_CLOSE, MARKS, NEXT, OTHER_CLOSE, OTHER_OPEN, OTHER_TEXT, START, USER_CLOSE, USER_OPEN

    def extra(column: str) -> str:
        """Characters that escaping adds."""
        counts = [f"length({column}) - length(replace({column}, '\\', ''))"]
        counts += [f"(length({column}) - length(replace({column}, '{m}', ''))) // {len(m)}" for m in MARKS]
        return " + ".join(counts)

    role = f"length(role) + {extra('role')}"
    return f"""
    WITH turns AS (
        SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ),
    marked AS (
        SELECT *, coalesce(lag(role) OVER w = role, FALSE) AS more, coalesce(lead(role) OVER w = role, FALSE) AS goes_on
        FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
    ),
    sized AS (
        SELECT *, length(text) + {extra('text')}
            + CASE WHEN more THEN {len(NEXT)} WHEN role = 'user' THEN {len(USER_OPEN)} WHEN role = 'assistant' THEN 0
                   ELSE {len(OTHER_OPEN) + len(OTHER_TEXT)} + {role} END
            + CASE WHEN goes_on THEN 0 WHEN role = 'user' THEN {len(USER_CLOSE)}
                   WHEN role = 'assistant' THEN {len(ASSISTANT_CLOSE)} ELSE {len(OTHER_CLOSE)} END AS chars,
            CASE WHEN role = 'assistant' THEN text ELSE '' END AS trained
        FROM marked
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        sum(length(trained))::BIGINT AS loss_chars,
        sha256(string_agg(trained, '' ORDER BY turn, role, text)) AS loss_sha256,
        ({len(START)} + sum(chars))::BIGINT AS formatted_chars
    FROM sized GROUP BY conv_id
    """


@query("op7_chat_turns", _chat_sql())
def op7_chat_turns(spark: SparkSession, folder: str) -> DataFrame:
    from .chat import formatted_conversations, read_back

    own = spark.sql(
        "SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') "
        "AS t(conv_id, turn, role, text)"
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return read_back(formatted_conversations(turns))


@query(
    "op11_target_resampling",
    f"""
    WITH crc_table AS (
        SELECT list(c ORDER BY i) AS t FROM (
            SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
            FROM range(256) r(i))
    ),
    own AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM_WORDS} AS w FROM documents),
    own_words AS (SELECT r, unnest(w) AS word FROM own),
    asked_words AS (SELECT unnest({_ALNUM_WORDS}) AS word FROM benchmark),
    hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM own_words UNION SELECT word FROM asked_words)),
    bytes AS (SELECT word, list_transform(range(1, length(h), 2), lambda p: ('0x' || h[p:p + 1])::BIGINT) AS b FROM hexed),
    hashed AS (
        SELECT word, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
        FROM bytes, crc_table
    ),
    s AS (SELECT bucket, count(*) AS n FROM own_words JOIN hashed USING (word) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS n FROM asked_words JOIN hashed USING (word) GROUP BY bucket),
    gain AS (
        SELECT s.bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * (SELECT sum(n) + 10000 FROM s)::DOUBLE)
            / ((s.n + 1)::DOUBLE * (SELECT coalesce(sum(n), 0) + 10000 FROM t)::DOUBLE)))::BIGINT AS g
        FROM s LEFT JOIN t USING (bucket)
    ),
    weights AS (SELECT r, sum(g)::BIGINT AS weight FROM own_words JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY r),
    scored AS (
        SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
            (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
        FROM own LEFT JOIN weights USING (r)
    ),
    ranked AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place FROM scored)
    SELECT doc_id, n_features, weight, score,
        CASE WHEN place <= (SELECT count(*) * 10 // 100 FROM scored WHERE n_features >= 20) THEN place END AS rank
    FROM ranked
    """,
)
def op11_target_resampling(spark: SparkSession, folder: str) -> DataFrame:
    from .resample import resampled

    found = resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query(
    "op12_filter_audit",
    """
    WITH words AS (
        SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part,
            list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
        FROM documents
    ),
    failed AS (
        SELECT part,
            CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
            || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
            || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
            || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
            || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails,
            doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
            doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
        FROM words
    ),
    counted AS (
        SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
        FROM failed GROUP BY part, fails
    ),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
    orders AS (
        SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
    ),
    steps AS (
        SELECT filter_order, step::INT AS step, filter_order[step:step] AS own, list_filter(string_split(filter_order[1:step - 1], ''), lambda x: x <> '') AS earlier
        FROM orders, range(1, 6) r(step)
    ),
    places AS (
        SELECT part, filter_order, step, own,
            coalesce(sum(n) FILTER (NOT early AND NOT now), 0) AS kept,
            coalesce(sum(n) FILTER (NOT early AND now), 0) AS removed,
            coalesce(sum(n) FILTER (early AND now), 0) AS redundant,
            coalesce(sum(n) FILTER (fails = own), 0) AS unique_fails,
            coalesce(sum(n_good) FILTER (NOT early AND now), 0) AS good_lost,
            coalesce(sum(n_toxic) FILTER (NOT early AND now), 0) AS toxic_lost
        FROM (
            SELECT *, contains(fails, own) AS now, list_has_any(string_split(fails, ''), earlier) AS early FROM counted, steps
        ) GROUP BY part, filter_order, step, own
    )
    SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
        unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
        (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
    FROM places
    """,
)
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    from .audit import filter_audit

    return filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op13_simhash_balls")
def op13_simhash_balls(spark: SparkSession, folder: str) -> DataFrame:
    from .simhash import near_fingerprints

    return near_fingerprints(table(spark, folder, "documents"))
