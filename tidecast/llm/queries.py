"""The registered queries of the training-data operators, and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm.chat import chat_windows, window_digests
from tidecast.llm.common import ORACLES, QUERIES, materialize, query, table
from tidecast.llm.embeddings import near_vectors
from tidecast.llm.exact import exact_groups
from tidecast.llm.jaccard import near_components
from tidecast.llm.middle import middle_digests, middle_pieces
from tidecast.llm.mixing import count_tokens, domain_of, mix_sources
from tidecast.llm.packing import pack_documents
from tidecast.llm.quality import quality_scores
from tidecast.llm.rules import COUNTS, clean_lines
from tidecast.llm.secrets import secret_report
from tidecast.llm.substrings import without_repeats
from tidecast.llm.toxicity import toxicity_scores
from tidecast.llm.variants import spelling_variants


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pack_with_public_vocabulary(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack_documents(
        docs,
        tokenizer_path("byte_bpe_50k.json"),
        tokenizer_path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query("op1_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), length=400)


@query("op3_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_with_public_vocabulary(table(spark, sf_dir, "documents"))


@query("op4_ngram_jaccard")
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"), words=3, percent=90)


@query("op5_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)


@query(
    "op6_exact_dedup",
    """
    SELECT doc_id,
           max(doc_id) OVER same AS keep_id,
           count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept,
           sha256(norm) AS text_sha256
    FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                   'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
    WINDOW same AS (PARTITION BY norm)
    """,
)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@query("op7_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Target weights of the mixture; names that are not listed weigh 1.
MIX_WEIGHTS = {
    "domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 2},
    "lang": {"en": 5, "de": 2, "fr": 2},
    "source": {"src0": 2},
}
MIX_PERCENT, MIX_EPOCHS, MIX_SEED = 60, 2, 7


def mix_tree() -> dict:
    return {
        "domain": domain_of("source"),
        "lang": F.coalesce("lang", F.lit("")),
        "source": F.coalesce("source", F.lit("")),
    }


def mix_documents(docs: DataFrame, epochs: int = MIX_EPOCHS, epoch: str = "mix_epoch") -> DataFrame:
    """``docs`` with the column ``epoch``, one row per selected copy."""
    tokens = docs.select(
        "doc_id", *(c.alias(k) for k, c in mix_tree().items()), count_tokens().alias("n_tokens")
    )
    return mix_sources(
        docs,
        materialize(tokens, "mix-tokens"),
        mix_tree(),
        MIX_WEIGHTS,
        count_tokens(),
        MIX_PERCENT,
        epochs,
        MIX_SEED,
        epoch,
    )


def _weight_sql(level: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in MIX_WEIGHTS[level].items())
    return f"(CASE {level} {cases} ELSE 1 END)::HUGEINT"


def _level_sql(name: str, above: list[str], level: str, part: str) -> str:
    """CTEs that share ``part`` of the parent's table among the children at ``level``."""
    names = ", ".join([*above, level])
    parent = f"PARTITION BY {', '.join(above)}" if above else ""
    join = f"JOIN {part} USING ({', '.join(above)})" if above else ""
    given = "given AS part" if above else f"(SELECT sum(tokens) FROM leaves) * {MIX_PERCENT} // 100 AS part"
    return f"""
    {name}0 AS (
        SELECT c.*, {given}, {_weight_sql(level)} AS w, c.cap::DOUBLE / w AS ratio
        FROM (SELECT {names}, sum(tokens) * {MIX_EPOCHS} AS cap FROM leaves GROUP BY {names}) c {join}
    ),
    {name}1 AS (
        SELECT *, sum(cap) OVER up_to - cap AS before,
               sum(w) OVER whole - sum(w) OVER up_to + w AS remaining
        FROM {name}0
        WINDOW up_to AS ({parent} ORDER BY ratio, {level} ROWS UNBOUNDED PRECEDING),
               whole AS ({parent})
    ),
    {name}2 AS (
        SELECT *, (part - before) * w >= cap * remaining AS filled,
               CASE WHEN (part - before) * w >= cap * remaining THEN 0 ELSE w END AS open_w
        FROM {name}1
    ),
    {name}3 AS (
        SELECT *, part - coalesce(sum(cap) FILTER (filled) OVER whole, 0) AS rest,
               sum(open_w) OVER whole AS open_all, sum(open_w) OVER up_to AS open_to
        FROM {name}2
        WINDOW up_to AS ({parent} ORDER BY ratio, {level} ROWS UNBOUNDED PRECEDING),
               whole AS ({parent})
    ),
    {name} AS (
        SELECT {names}, CASE WHEN filled THEN cap ELSE
               (rest * open_to) // open_all - (rest * (open_to - w)) // open_all END AS given
        FROM {name}3
    )"""


_MIX_SQL = f"""
    WITH docs AS (
        SELECT doc_id,
               CASE WHEN number = '' THEN 'x' ELSE 'd' || (number::BIGINT // 5) END AS domain,
               coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens
        FROM (SELECT *, regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) AS number
              FROM documents)
    ),
    leaves AS (
        SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens FROM docs
        GROUP BY domain, lang, source
    ),
    {_level_sql("by_domain", [], "domain", "")},
    {_level_sql("by_lang", ["domain"], "lang", "by_domain")},
    {_level_sql("by_source", ["domain", "lang"], "source", "by_lang")},
    budgets AS (
        SELECT *, coalesce(given // nullif(tokens, 0), 0) AS epochs,
               given - coalesce(given // nullif(tokens, 0), 0) * tokens AS rest
        FROM leaves JOIN by_source USING (domain, lang, source)
    ),
    placed AS (
        SELECT d.*, epochs, rest,
               sum(n_tokens) OVER (
                   PARTITION BY domain, lang, source
                   ORDER BY md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), '{MIX_SEED}',
                                          epochs::VARCHAR)), doc_id
                   ROWS UNBOUNDED PRECEDING) AS upto
        FROM docs d JOIN budgets USING (domain, lang, source)
    )
    SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens,
           unnest(range(0, (epochs + CASE WHEN upto <= rest AND (rest > 0 OR epochs = 0)
                                     THEN 1 ELSE 0 END)::BIGINT)) AS mix_epoch
    FROM placed
"""


@query("op8_source_mixing", _MIX_SQL)
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    narrow = materialize(
        docs.select(
            "doc_id", *(c.alias(k) for k, c in mix_tree().items()), count_tokens().alias("n_tokens")
        ),
        "mix-tokens",
    )
    return mix_sources(
        narrow,
        narrow,
        {k: F.col(k) for k in mix_tree()},
        MIX_WEIGHTS,
        F.col("n_tokens"),
        MIX_PERCENT,
        MIX_EPOCHS,
        MIX_SEED,
    )


@query("op9_secret_scans")
def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


@query("op10_chat_formatting")
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    windows = chat_windows(
        rows.unionByName(extra), tokenizer_path=tokenizer_path("byte_bpe_50k.json")
    )
    return window_digests(windows)


_MIDDLE_SQL = r"""
    WITH units AS (
        SELECT doc_id, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
               sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
        FROM documents
    ),
    cuts AS (
        SELECT *, len(u) AS n,
               ('0x' || h[1:8])::UBIGINT % (len(u) + 1) AS c1,
               ('0x' || h[9:16])::UBIGINT % (len(u) + 1) AS c2,
               CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                         OR ('0x' || h[17:24])::UBIGINT % 100 >= 100 THEN 'plain'
                    WHEN ('0x' || h[25:32])::UBIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
        FROM units
    ),
    parts AS (
        SELECT *, coalesce(array_to_string(u[1:least(c1, c2)], ''), '') AS p,
               coalesce(array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS m,
               coalesce(array_to_string(u[greatest(c1, c2) + 1:], ''), '') AS s
        FROM cuts
    )
    SELECT doc_id, n::BIGINT AS n, form,
           CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t
                  WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM parts
"""


@query("op11_fill_in_middle", _MIDDLE_SQL)
def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle_digests(middle_pieces(table(spark, sf_dir, "documents"))).drop("row")


#: crc32 goes byte by byte; near words share what is left without one letter.
_VARIANTS_SQL = r"""
    WITH RECURSIVE steps AS (
        SELECT i::UBIGINT AS i, i::UBIGINT AS v, 0 AS k FROM range(256) AS t(i)
        UNION ALL
        SELECT i, xor(v >> 1, (v & 1) * 3988292384::UBIGINT), k + 1 FROM steps WHERE k < 8
    ),
    crc_table AS (SELECT i, v FROM steps WHERE k = 8),
    runs AS (
        SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[A-Za-z\x{C0}-\x{FF}]+')) AS run
        FROM documents
    ),
    counted AS (
        SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS bytes
        FROM runs WHERE length(run) >= 7 GROUP BY id, run
    ),
    crc AS (
        SELECT id, run, n, bytes, 4294967295::UBIGINT AS c, 0 AS pos FROM counted
        UNION ALL
        SELECT id, run, n, bytes, xor(c >> 8, v), pos + 2
        FROM crc JOIN crc_table ON i = xor(c & 255, ('0x' || bytes[pos + 1:pos + 2])::UBIGINT)
        WHERE pos < length(bytes)
    ),
    hashed AS (
        SELECT run, n, xor(c, 4294967295::UBIGINT) AS h FROM crc WHERE pos = length(bytes)
    ),
    words AS (
        SELECT word, sum(n)::BIGINT AS n
        FROM (SELECT n, CASE WHEN h % 31 = 0 THEN
                  run[1:(h % length(run))::INT] || run[(h % length(run))::INT + 2:]
                  ELSE run END AS word FROM hashed)
        WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
    ),
    holes AS (
        SELECT word, n, i, word[1:i - 1] AS a, word[i + 1:] AS b
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
    ),
    shorter AS (
        SELECT DISTINCT h.word AS long_word, h.n AS long_n, w.word AS short_word, w.n AS short_n
        FROM holes h JOIN words w ON w.word = h.a || h.b
    ),
    pairs AS (
        SELECT x.word, x.n, y.word AS other, y.n AS other_n
        FROM holes x JOIN holes y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
        UNION ALL SELECT long_word, long_n, short_word, short_n FROM shorter
        UNION ALL SELECT short_word, short_n, long_word, long_n FROM shorter
    ),
    best AS (
        SELECT word, count(*) AS n_near, max(other_n) AS best_n,
               first(other ORDER BY other_n DESC, encode(other)) AS other
        FROM pairs GROUP BY word
    ),
    forms AS (
        SELECT words.word, n, coalesce(n_near, 0) AS n_near,
               CASE WHEN best_n >= 10 * n THEN other END AS form,
               CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
        FROM words LEFT JOIN best USING (word)
    ),
    chains AS (
        SELECT word, word AS root FROM forms
        UNION ALL
        SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.root
        WHERE f.form IS NOT NULL
    ),
    ends AS (
        SELECT c.word, c.root FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NULL
    )
    SELECT word, n, n_near, form, form_n, root FROM forms JOIN ends USING (word)
"""


@query("op12_spelling_variants", _VARIANTS_SQL)
def spelling_variant_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


_RULES_SQL = r"""
    WITH docs AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
    ),
    split AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS l FROM docs),
    words AS (SELECT r, unnest(l) AS w, generate_subscripts(l, 1) AS i FROM split),
    counted AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM words GROUP BY r),
    windows AS (
        SELECT r, i, w || ' ' || lead(w, 1) OVER next || ' ' || lead(w, 2) OVER next AS x
        FROM words WINDOW next AS (PARTITION BY r ORDER BY i)
    ),
    again AS (
        SELECT r, i FROM windows WHERE x IS NOT NULL
        QUALIFY count(*) OVER (PARTITION BY r, x) > 1
    ),
    covered AS (
        SELECT r, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS v(k) GROUP BY r
    ),
    lines AS (
        SELECT r, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
               lower(l) AS low,
               length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) AS chars
        FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM docs)
        WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
    ),
    judged AS (
        SELECT r, l, chars,
               NOT regexp_matches(l, '[.!?:;…][''"”’»)\]]*[\x20\x09-\x0D]*\z|[.!?…][\x20\x09-\x0D]')
               OR len(regexp_extract_all(l, '[!?#*$%&<>|=~^_]{2,}')) * 5 > n
               OR (regexp_matches(l, '[|»›•·]') AND len(regexp_extract_all(l, '[|»›•·]')) * 4 >= n)
               OR (n <= 8 AND regexp_matches(low, 'read more|click here|back to top|skip to content|next page|previous page|sign in|log in|sign up|contact us|about us|site map'))
               OR regexp_matches(low, 'all rights reserved|privacy policy|cookie policy|use cookies|uses cookies|terms of use|terms of service|terms and conditions|javascript|lorem ipsum|licensed under|released under the|copyright|©|subscribe to our|powered by')
               AS failed
        FROM lines
    ),
    by_line AS (
        SELECT r, count(*) - count(DISTINCT l) AS n_dup_lines, count(*) AS n_lines,
               count(*) FILTER (failed) AS n_failed_lines,
               coalesce(sum(chars) FILTER (failed), 0) AS lost_chars
        FROM judged GROUP BY r
    ),
    counts AS (
        SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words,
               coalesce(word_chars, 0)::BIGINT AS word_chars,
               length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
               coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
               coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
               coalesce(n_lines, 0)::BIGINT AS n_lines,
               coalesce(n_failed_lines, 0)::BIGINT AS n_failed_lines,
               coalesce(lost_chars, 0)::BIGINT AS lost_chars
        FROM docs LEFT JOIN counted USING (r) LEFT JOIN covered USING (r) LEFT JOIN by_line USING (r)
    )
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
           AND 100 * lost_chars <= 30 * word_chars AS kept
    FROM counts
"""


@query("op13_quality_rules", _RULES_SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = clean_lines(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept")


def all_queries() -> dict:
    return dict(QUERIES)


def all_oracles() -> dict:
    return dict(ORACLES)
