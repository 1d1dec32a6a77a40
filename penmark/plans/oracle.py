"""For each registered query, the SQL that must give the same rows.

Written for DuckDB against the plain tables. Queries that fit a model have none.
"""

from __future__ import annotations

from penmark.functions import lexicon as lx
from penmark.operators.projection import SAMPLE_ROWS, SAMPLE_SEED
from penmark.operators.tfidf import MIN_DF, VOCAB_SIZE
from penmark.sources.corpus import GENERATION_METHODS
from penmark.sources.tables import (
    ARABIC_LETTERS,
    BARE_LETTER,
    ENTITY_TAIL,
    LATIN_LETTERS,
    MARKED_LETTER,
    MARKER_WORDS,
)


def words(items) -> str:
    return "[" + ", ".join(f"'{w}'" for w in items) + "]"


def marker(m: int, o: int) -> str:
    return f"{words(MARKER_WORDS)}[(doc_id * {m} + {o}) % {len(MARKER_WORDS)} + 1]"


BASE = (
    f"{marker(1, 0)} || ' ' || {marker(3, 1)} || ' ' || "
    f"translate(lower(text), '{LATIN_LETTERS}', '{ARABIC_LETTERS}') || ' ' || {marker(7, 2)}"
)

WIDE = f"""based AS (SELECT doc_id, {BASE} AS base FROM documents),
wide AS (
  SELECT doc_id,
    base AS original_abstract,
    {marker(1, 5)} || ' ' || base AS allam_generated_abstract,
    replace(base, ',', '') || '{ENTITY_TAIL}' AS jais_generated_abstract,
    replace(base, '{BARE_LETTER}', '{MARKED_LETTER}') AS llama_generated_abstract,
    CASE WHEN doc_id % 10 <> 0 THEN reverse(base) END AS openai_generated_abstract,
    {words(GENERATION_METHODS)}[doc_id % 3 + 1] AS generation_method
  FROM based)"""

LONG = f"""{WIDE},
corpus AS (
  SELECT doc_id, generation_method,
    unnest(['original', 'allam', 'jais', 'llama', 'openai']) AS generator,
    unnest(['human', 'ai', 'ai', 'ai', 'ai']) AS label,
    unnest([original_abstract, allam_generated_abstract, jais_generated_abstract,
            llama_generated_abstract, openai_generated_abstract]) AS text
  FROM wide)"""


def clean(text: str = "text", kept: str = r"\x{0600}-\x{06FF}") -> str:
    dropped = lx.DIACRITICS + lx.TATWEEL
    return (
        f"trim(regexp_replace(translate(coalesce({text}, ''), '{lx.FOLD_FROM}{dropped}', '{lx.FOLD_TO}'),"
        f" '[^{kept}]+', ' ', 'g'))"
    )


def tokens(stop=lx.STOP_WORDS) -> str:
    return (
        "list_filter(string_split(clean_text, ' '), "
        f"lambda w: length(w) > 1 AND NOT list_contains({words(stop)}, w))"
    )


def prepared(source: str = "corpus", stop=lx.STOP_WORDS) -> str:
    return (
        f"cleaned AS (SELECT *, {clean()} AS clean_text FROM {source}),\n"
        f"prepared AS (SELECT *, {tokens(stop)} AS tokens FROM cleaned)"
    )


PREPARED = f"{LONG},\n{prepared()}"


def listed(items) -> str:
    return f"len(list_filter(tokens, lambda w: list_contains({words(items)}, w)))::INTEGER"


AVG_WORD = "CASE WHEN len(tokens) > 0 THEN length(array_to_string(tokens, ''))::DOUBLE / len(tokens) ELSE 0.0 END"
QUESTIONS = (
    f"(length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{lx.QUESTION_MARKS}', '')))::INTEGER"
)


def mentions(markers) -> str:
    pair = f"CASE WHEN list_contains({words(markers)}, ws[i]) THEN ws[i] || ' ' || ws[i + 1] END"
    return f"list_filter(list_transform(range(1, len(ws)), lambda i: {pair}), lambda x: x IS NOT NULL)"


def featured(profile: lx.LanguageProfile = lx.ARABIC) -> str:
    return f"""split AS (SELECT *, string_split(clean_text, ' ') AS ws FROM prepared),
mentioned AS (SELECT *, {mentions(profile.entity_markers)} AS found FROM split),
featured AS (SELECT *,
  {AVG_WORD} AS feature_10_avg_word_length,
  {QUESTIONS} AS feature_30_question_marks,
  {listed(profile.prepositions)} AS feature_50_prepositions,
  {listed(profile.first_person)} AS feature_70_first_person,
  CASE WHEN len(found) > 0 THEN len(list_distinct(found))::DOUBLE / len(found) ELSE 0.0 END
    AS feature_90_entity_diversity
  FROM mentioned)"""


FEATURED = f"{PREPARED},\n{featured()}"
FOLDED = lx.ARABIC.folded()

WORDS = f"{PREPARED},\nw AS (SELECT doc_id, generator, unnest(tokens) AS word FROM prepared)"
WORD_COUNT = f"{WORDS},\nc AS (SELECT word, count(*)::BIGINT AS count FROM w GROUP BY word)"
BIGRAMS = f"""{PREPARED},
b AS (SELECT doc_id, generator,
  list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1]) AS pairs FROM prepared)"""
BIGRAM_COUNT = f"""{BIGRAMS},
c AS (SELECT bigram, count(*)::BIGINT AS count FROM (SELECT unnest(pairs) AS bigram FROM b) GROUP BY bigram)"""

TERMS = f"""{WORDS},
tf AS (SELECT doc_id, generator, word AS term, count(*) AS tf FROM w GROUP BY ALL),
vocab AS (
  SELECT term, sum(tf)::BIGINT AS cf, count(*)::BIGINT AS df FROM tf GROUP BY term
  HAVING count(*) >= {MIN_DF} ORDER BY cf DESC, term LIMIT {VOCAB_SIZE}),
idf AS (SELECT term, df, ln(((SELECT count(*) FROM prepared) + 1)::DOUBLE / (df + 1)) AS idf FROM vocab)"""

RULES = """p AS (
  SELECT l.doc_id, l.quality AS label_index, d.n_chars, d.lang, d.source
  FROM labels l JOIN documents d USING (doc_id)),
predictions AS (
  SELECT doc_id, label_index, unnest(['length', 'language', 'source']) AS model,
    unnest([(n_chars >= 400)::INT, (lang = 'en')::INT, (source <> 'src7')::INT])::DOUBLE AS prediction
  FROM p),
one AS (SELECT * FROM predictions WHERE model = 'length')"""

CELLS = f"""{RULES},
cells AS (SELECT model,
  count(*) FILTER (label_index = 0 AND prediction = 0) AS TN,
  count(*) FILTER (label_index = 0 AND prediction = 1) AS FP,
  count(*) FILTER (label_index = 1 AND prediction = 0) AS FN,
  count(*) FILTER (label_index = 1 AND prediction = 1) AS TP
  FROM predictions GROUP BY model)"""

# Class by class from the rows themselves: precision, recall, then their harmonic mean.
F1 = f"""{RULES},
classes AS (SELECT DISTINCT model, label_index AS cls FROM predictions),
per_class AS (
  SELECT c.model, c.cls,
    count(*) FILTER (p.label_index = c.cls) AS support,
    count(*) FILTER (p.prediction = c.cls) AS predicted,
    count(*) FILTER (p.label_index = c.cls AND p.prediction = c.cls) AS hits
  FROM classes c JOIN predictions p USING (model) GROUP BY ALL),
f AS (
  SELECT model, support,
    coalesce(hits::DOUBLE / nullif(predicted, 0), 0) AS prec, coalesce(hits::DOUBLE / nullif(support, 0), 0) AS rec
  FROM per_class),
scored AS (SELECT model, sum(support * coalesce(2 * prec * rec / nullif(prec + rec, 0), 0)) / sum(support) AS f1
  FROM f GROUP BY model),
acc AS (SELECT model, avg((label_index = prediction)::INT) AS accuracy FROM predictions GROUP BY model)"""

COMPARISON = f"""{CELLS}{F1[len(RULES):]}
SELECT model AS "Model", round(accuracy, 6) AS "Accuracy", round(f1, 6) AS "F1-Score",
  TN::BIGINT AS "TN", FP::BIGINT AS "FP", FN::BIGINT AS "FN", TP::BIGINT AS "TP"
FROM cells JOIN scored USING (model) JOIN acc USING (model)"""

# Text files are cut at line feeds.
LINES = f"""{LONG},
lines AS (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS text FROM corpus)"""
LINE_COUNT = f"WITH {LINES} SELECT text, count(*)::BIGINT AS count FROM lines GROUP BY text"

WIDE_TEXTS = (
    "doc_id, original_abstract, allam_generated_abstract, jais_generated_abstract, "
    "llama_generated_abstract, openai_generated_abstract"
)


def _profile() -> str:
    columns = [("doc_id", "bigint"), *[(c, "string") for c in WIDE_TEXTS.split(", ")[1:]], ("generation_method", "string")]
    rows = []
    for name, kind in columns:
        blank = f"count(*) FILTER (trim({name}) = '')" if kind == "string" else "0"
        rows.append(
            f"SELECT '{name}' AS column_name, '{kind}' AS data_type, count(*)::BIGINT AS n_rows, "
            f"count(*) FILTER ({name} IS NULL)::BIGINT AS n_null, ({blank})::BIGINT AS n_blank FROM wide"
        )
    return f"WITH {WIDE}\n" + "\nUNION ALL ".join(rows)


BUCKET = "('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 100"
SPLIT = f"CASE WHEN {BUCKET} < 70 THEN 'train' WHEN {BUCKET} < 85 THEN 'validation' ELSE 'test' END"


STYLE = (
    "feature_10_avg_word_length",
    "feature_30_question_marks",
    "feature_50_prepositions",
    "feature_70_first_person",
    "feature_90_entity_diversity",
)

# Vocabulary and weights of the training rows, and what they make of every row.
TRAINED = f"""{WORDS},
tf AS (SELECT doc_id, generator, word AS term, count(*) AS tf FROM w GROUP BY ALL),
train AS (SELECT * FROM tf WHERE {SPLIT} = 'train'),
vocab AS (
  SELECT term, count(*)::BIGINT AS df FROM train GROUP BY term
  HAVING count(*) >= {MIN_DF} ORDER BY sum(tf) DESC, term LIMIT {VOCAB_SIZE}),
idf AS (SELECT term, ln(((SELECT count(*) FROM prepared WHERE {SPLIT} = 'train') + 1)::DOUBLE / (df + 1)) AS idf FROM vocab),
sums AS (
  SELECT doc_id, generator, count(*) AS n_tf, sum(tf)::DOUBLE AS total_tf,
    count(*) FILTER (tf * idf <> 0) AS n_tfidf, sum(tf * idf) AS total_tfidf
  FROM tf JOIN idf USING (term) GROUP BY ALL),
vectors AS (
  SELECT doc_id, generator, coalesce(n_tf, 0) AS n_tf, coalesce(total_tf, 0) AS total_tf,
    coalesce(n_tfidf, 0) AS n_tfidf, coalesce(total_tfidf, 0) AS total_tfidf
  FROM prepared LEFT JOIN sums USING (doc_id, generator))"""

STREAM_PREPARED = (
    f"cleaned AS (SELECT *, {clean(kept=chr(92) + 'x{0600}-' + chr(92) + 'x{06FF}?')} AS clean_text FROM corpus),\n"
    f"prepared AS (SELECT *, {tokens(lx.STREAM_STOP_WORDS)} AS tokens FROM cleaned)"
)


def _per_row(name: str, expression: str, source: str = LONG, table: str = "corpus") -> str:
    return f"WITH {source} SELECT doc_id, generator, {expression} AS {name} FROM {table}"


SQL: dict[str, str] = {
    # sources and sinks
    "s1_csv_scan": f"WITH {WIDE} SELECT {WIDE_TEXTS} FROM wide",
    "s2_multi_file_scan": f"WITH {WIDE} SELECT {WIDE_TEXTS}, generation_method FROM wide",
    "s2_scan_per_origin": f"WITH {WIDE} SELECT {WIDE_TEXTS}, generation_method FROM wide",
    "s1_csv_headers_in_any_order": f"WITH {WIDE} SELECT {WIDE_TEXTS} FROM wide",
    "s3_parquet_scan": "SELECT doc_id, lang, source, n_chars FROM documents",
    "s4_parquet_sink": f"WITH {LONG} SELECT *, {SPLIT} AS split FROM corpus",
    "s5_word_count_csv": f"WITH {WORD_COUNT} SELECT * FROM c",
    "s6_metrics_csv": f"WITH {COMPARISON}",
    "s11_profile": _profile(),
    # projections and reshape
    "p1_constant_column": "SELECT doc_id, 'by_polishing' AS generation_method FROM documents",
    "p2_select_rename": "SELECT conv_id, turn, text AS utterance FROM conversations",
    "p3_wide_to_long": f"WITH {LONG} SELECT * FROM corpus",
    "p4_label_index": "SELECT conv_id, turn, CASE role WHEN 'assistant' THEN 1 WHEN 'user' THEN 0 END AS label_index"
    " FROM conversations",
    "p5_decode_prediction": f"WITH {RULES} SELECT doc_id, prediction,"
    " CASE WHEN prediction = 1 THEN 'AI' ELSE 'Human' END AS detected_as FROM one",
    "p6_class_name": "SELECT doc_id, CASE quality WHEN 0 THEN 'Human' WHEN 1 THEN 'AI' END AS class_name FROM labels",
    "p8_vector_element": "SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS x0, round(embedding[2]::DOUBLE, 6) AS x1"
    " FROM embeddings",
    "p9_range_trim": "SELECT doc_id, n_chars FROM documents WHERE n_chars BETWEEN"
    " (SELECT quantile_cont(n_chars, 0.01) FROM documents) AND (SELECT quantile_cont(n_chars, 0.99) FROM documents)",
    # aggregates
    "a1_row_count": f"WITH {LONG} SELECT count(*)::BIGINT AS n_rows FROM corpus",
    "a2_group_count_label": f"WITH {LONG} SELECT label, count(*)::BIGINT AS count FROM corpus GROUP BY label",
    "a2_group_count_method": f"WITH {LONG} SELECT generation_method, count(*)::BIGINT AS count FROM corpus GROUP BY ALL",
    "a3_word_count": f"WITH {WORD_COUNT} SELECT * FROM c",
    "a4_bigram_count": f"WITH {BIGRAM_COUNT} SELECT * FROM c",
    "a5_distinct_words": f"WITH {WORDS} SELECT count(DISTINCT word)::BIGINT AS unique_tokens FROM w",
    "a6_type_token_ratio": f"WITH {WORDS} SELECT count(*)::BIGINT AS total_tokens,"
    " count(DISTINCT word)::BIGINT AS unique_tokens, round(count(DISTINCT word)::DOUBLE / count(*), 6) AS ttr FROM w",
    "a7_feature_means": f"WITH {FEATURED} SELECT label, "
    + ", ".join(
        f"round(avg({c}), 6) AS avg_{c}"
        for c in (
            "feature_10_avg_word_length",
            "feature_30_question_marks",
            "feature_50_prepositions",
            "feature_70_first_person",
            "feature_90_entity_diversity",
        )
    )
    + " FROM featured GROUP BY label",
    "a8_idf": f"WITH {TERMS} SELECT term, df, round(idf, 6) AS idf FROM idf",
    "a8_tfidf": f"WITH {TERMS} SELECT doc_id, generator, term, tf::BIGINT AS tf, round(tf * idf, 6) AS tfidf"
    " FROM tf JOIN idf USING (term)",
    "a9_vocabulary": f"WITH {TERMS} SELECT term, cf, df FROM vocab",
    "a10_confusion_counts": f"WITH {RULES} SELECT label_index, prediction, count(*)::BIGINT AS count FROM one GROUP BY ALL",
    "a11_confusion_cells": f"WITH {CELLS} SELECT TN::BIGINT AS \"TN\", FP::BIGINT AS \"FP\", FN::BIGINT AS \"FN\","
    " TP::BIGINT AS \"TP\" FROM cells WHERE model = 'length'",
    "a12_accuracy": f"WITH {RULES} SELECT model, round(avg((label_index = prediction)::INT), 6) AS accuracy"
    " FROM predictions GROUP BY model",
    "a13_weighted_f1": f"WITH {F1} SELECT model, round(f1, 6) AS f1 FROM scored",
    "a14_quantiles": "SELECT count(n_chars)::BIGINT AS n_values, round(quantile_cont(n_chars, 0.01), 6) AS q01,"
    " round(quantile_cont(n_chars, 0.99), 6) AS q99 FROM documents",
    "a15_model_comparison": f"WITH {COMPARISON}",
    "a15_class_recall": f"WITH {RULES} SELECT model,"
    " round(avg((prediction = 0)::INT) FILTER (label_index = 0), 6) AS human_recall,"
    " round(avg((prediction = 1)::INT) FILTER (label_index = 1), 6) AS ai_recall FROM predictions GROUP BY model",
    # order, samples, splits
    "t1_top_20_words": f"WITH {WORD_COUNT} SELECT * FROM c ORDER BY count DESC, word LIMIT 20",
    "t1_top_30_words": f"WITH {WORD_COUNT} SELECT * FROM c ORDER BY count DESC, word LIMIT 30",
    "t1_top_300_words": f"WITH {WORD_COUNT} SELECT * FROM c ORDER BY count DESC, word LIMIT 300",
    "t2_top_20_bigrams": f"WITH {BIGRAM_COUNT} SELECT * FROM c ORDER BY count DESC, bigram LIMIT 20",
    "t3_sorted_word_count": f"WITH {WORD_COUNT} SELECT * FROM c ORDER BY count DESC, word",
    "t4_peek": f"WITH {PREPARED} SELECT doc_id, generator, label, generation_method, clean_text FROM prepared"
    " ORDER BY doc_id, generator LIMIT 20",
    "t5_seeded_sample": f"SELECT doc_id, n_chars FROM documents ORDER BY md5('{SAMPLE_SEED}|' || doc_id), doc_id"
    f" LIMIT {SAMPLE_ROWS}",
    "t6_hash_split": f"SELECT doc_id, {SPLIT} AS split FROM documents",
    # unions
    "u1_union_missing_columns": f"WITH {WIDE}, title AS (SELECT * EXCLUDE (openai_generated_abstract) FROM wide"
    " WHERE generation_method = 'from_title'), others AS (SELECT * FROM wide WHERE generation_method <> 'from_title')"
    " SELECT * FROM others UNION ALL BY NAME SELECT * FROM title",
    "u2_union_strict": f"WITH {WIDE} "
    + " UNION ALL BY NAME ".join(
        f"SELECT doc_id, generation_method, '{generator}' AS generator, '{label}' AS label, {column} AS text FROM wide"
        for generator, label, column in (
            ("original", "human", "original_abstract"),
            ("allam", "ai", "allam_generated_abstract"),
            ("jais", "ai", "jais_generated_abstract"),
            ("llama", "ai", "llama_generated_abstract"),
            ("openai", "ai", "openai_generated_abstract"),
        )
    ),
    # text functions
    "f1_strip_diacritics": _per_row("stripped", f"translate(text, '{lx.DIACRITICS}', '')"),
    "f2_fold_letters": _per_row("folded", f"translate(text, '{lx.FOLD_FROM}', '{lx.FOLD_TO}')"),
    "f3_drop_tatweel": _per_row("bare", f"replace(text, '{lx.TATWEEL}', '')"),
    "f4_keep_script": _per_row("kept", r"regexp_replace(text, '[^\x{0600}-\x{06FF}]+', ' ', 'g')"),
    "f4_keep_script_and_question_mark": _per_row(
        "kept", r"regexp_replace(text, '[^\x{0600}-\x{06FF}?]+', ' ', 'g')"
    ),
    "f5_collapse_spaces": _per_row(
        "collapsed",
        r"trim(regexp_replace(coalesce(text, ''), '[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]+', ' ', 'g'))",
    ),
    "f5_clean_text": _per_row("clean_text", "clean_text", PREPARED, "prepared"),
    "f6_tokens": f"WITH {PREPARED} SELECT doc_id, generator, len(tokens)::BIGINT AS n_tokens,"
    " array_to_string(tokens, ' ') AS tokens FROM prepared",
    "f6_stream_tokens": f"WITH {LONG},\n{STREAM_PREPARED} SELECT doc_id, generator, len(tokens)::BIGINT AS n_tokens,"
    " array_to_string(tokens, ' ') AS tokens FROM prepared",
    "f7a_avg_word_length": _per_row("avg_word_length", f"round({AVG_WORD}, 6)", PREPARED, "prepared"),
    "f7b_question_marks": _per_row("question_marks", QUESTIONS),
    "f7c_prepositions": _per_row("prepositions", listed(lx.PREPOSITIONS), PREPARED, "prepared"),
    "f7d_first_person": _per_row("first_person", listed(lx.FIRST_PERSON), PREPARED, "prepared"),
    "f7_folded_lexicon": f"WITH {LONG},\n{prepared(stop=FOLDED.stop_words)},\n{featured(FOLDED)}"
    " SELECT doc_id, generator, feature_50_prepositions, feature_70_first_person,"
    " round(feature_90_entity_diversity, 6) AS feature_90_entity_diversity FROM featured",
    "f8_entity_diversity": _per_row("entity_diversity", "round(feature_90_entity_diversity, 6)", FEATURED, "featured"),
    "f9_explode_tokens": f"WITH {WORDS} SELECT doc_id, generator, word FROM w",
    "f10_bigrams": f"WITH {BIGRAMS} SELECT doc_id, generator, array_to_string(pairs, '|') AS bigrams FROM b",
    # streams, whose rows do not depend on how they arrive
    "s7_text_stream": f"WITH {LINES} SELECT text AS value FROM lines",
    "s8_batch_sink": f"WITH {LINES},\n{prepared('lines')} SELECT text, clean_text FROM prepared",
    "x1_stream_lines": LINE_COUNT,
    "x4_x5_interval_append": f"WITH {LINES} SELECT length(text)::INTEGER AS n_chars, count(*)::BIGINT AS count FROM lines GROUP BY ALL",
    "x3_stream_equals_batch": f"WITH {LINES} SELECT count(*)::BIGINT AS n_lines, count(DISTINCT text)::BIGINT AS n_texts,"
    " 0::BIGINT AS n_differ FROM lines",
    "f11_one_time_per_batch": f"WITH {LINES} SELECT count(*)::BIGINT AS n_lines, 0::BIGINT AS n_without_time,"
    " 0::BIGINT AS n_mixed_batches FROM lines",
    # models: SQL knows the vectors, and which rows there are; that models differ nowhere is 0
    "m1_count_vectorizer": f"WITH {TRAINED} SELECT doc_id, generator, n_tf::INTEGER AS n_terms, round(total_tf, 4) AS total FROM vectors",
    "m2_idf": f"WITH {TRAINED} SELECT doc_id, generator, n_tfidf::INTEGER AS n_terms, round(total_tfidf, 4) AS total FROM vectors",
    "p7_assembled_vectors": f"WITH {TRAINED},\n{featured()} SELECT doc_id, generator,"
    f" (n_tfidf + {' + '.join(f'({c} <> 0)::INT' for c in STYLE)})::INTEGER AS n_terms,"
    f" round(total_tfidf + {' + '.join(STYLE)}, 4) AS total FROM vectors JOIN featured USING (doc_id, generator)",
    **{
        name: f"WITH {LONG} SELECT {SPLIT} AS split, (label = 'ai')::INTEGER AS label_index, count(*)::BIGINT AS n_rows,"
        " 0::BIGINT AS n_differ FROM corpus GROUP BY ALL"
        for name in ("m3_m6_s9_s10_logistic_regression", "m4_m6_s9_s10_linear_svm", "m5_m6_s9_s10_random_forest")
    },
    **{
        name: f"WITH {LONG} SELECT {SPLIT} AS split, (label = 'ai')::INTEGER AS label_index, count(*)::BIGINT AS n_rows,"
        " 0::BIGINT AS n_differ, true AS tells_apart FROM corpus GROUP BY ALL"
        for name in ("m3_scores_by_joins", "m4_scores_by_joins", "m5_scores_by_rules")
    },
    "m7_certificate": "SELECT range::INTEGER AS component, range - 1 AS n_larger, 0::DOUBLE AS residual, 0::DOUBLE AS off_orthonormal"
    " FROM range(1, 3)",
    "m8_better_lines": "SELECT 78::BIGINT AS n_tried, 0::BIGINT AS n_better",
    "m7_projected_rows": "SELECT vec_id, (label >= 5)::INTEGER AS label_index,"
    " CASE WHEN label >= 5 THEN 'AI' ELSE 'Human' END AS \"Class\", true AS has_point FROM embeddings",
    "m8_boundary_residuals": "SELECT range AS point, 0::DOUBLE AS off_y, 0::DOUBLE AS off_y_upper, 0::DOUBLE AS off_y_lower"
    " FROM range(200)",
    "m9_points_kept": "SELECT 0::BIGINT AS n_unknown, 0::BIGINT AS n_repeated, 0::BIGINT AS n_outside",
    "x2_stream_features": f"WITH {LINES},\n{prepared('lines')},\n{featured()}"
    " SELECT text, clean_text, len(tokens)::BIGINT AS n_tokens,"
    " round(feature_10_avg_word_length, 6) AS feature_10_avg_word_length, feature_30_question_marks,"
    " feature_50_prepositions, feature_70_first_person,"
    " round(feature_90_entity_diversity, 6) AS feature_90_entity_diversity FROM featured",
    "x6_stream_restart": LINE_COUNT,
}
