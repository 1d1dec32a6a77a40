import random

import pytest
from pyspark.sql import functions as F

import rules
from tests.conftest import plan_of
from penmark.functions import lexicon as lx
from penmark.functions import text as tx

HAND_WRITTEN = [
    None,
    "",
    "   \t\n ",
    "؟ ?",
    "جامعة",
    "مركز علم مركز علم مركز ادب",
    "مِنْ فِـي عَلَى البيت",
    "بيت كبير\u001cجدا\u0085هنا",
    "كتاب، قلم؛ ورقة؟",
    "سلام 😀 عليكم",
    "abc ABC 123",
    "إأآا ىؤئة",
    "و ف ب ل ك انا نحن",
    "تهدف هذه الدراسة إلى تحليل أثر الذكاء الاصطناعي على جودة التعليم وتحسين مخرجات التعلم.",
    "أنا كتبت هذا النص بنفسي لأشرح تجربتي مع المشروع خطوة بخطوة.",
    "جامعة جامعة جامعة",
    "ﻻ ﷺ ٱلله",
]


def fuzz(n, seed=7):
    rng = random.Random(seed)
    alphabet = (
        [chr(c) for c in range(0x0600, 0x0700)]
        + list(" \t\n \u001c\u0085 ?؟.,aZ9😀ﻻ")
        + [" "] * 40
    )
    listed = [*lx.STOP_WORDS, *lx.PREPOSITIONS, *lx.FIRST_PERSON, *lx.ENTITY_MARKERS]

    def one():
        parts = [
            rng.choice(listed) if rng.random() < 0.4 else "".join(rng.choices(alphabet, k=rng.randint(0, 6)))
            for _ in range(rng.randint(0, 25))
        ]
        return rng.choice(["", " ", "  "]).join(parts)

    return [one() for _ in range(n)]


def featured(spark, texts, profile=lx.ARABIC):
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    return tx.add_style_features(tx.prepare(rows, profile), profile)


@pytest.mark.parametrize("profile,keep,stop", [(lx.ARABIC, "", lx.STOP_WORDS), (lx.ARABIC_STREAM, "?", lx.STREAM_STOP_WORDS)])
def test_expressions_equal_the_rules(spark, profile, keep, stop):
    texts = HAND_WRITTEN + fuzz(4000)
    got = featured(spark, texts, profile).orderBy("id").collect()
    assert len(got) == len(texts)
    for row, raw in zip(got, texts):
        cleaned = rules.clean(raw, keep)
        toks = rules.tokens(cleaned, stop)
        assert row.clean_text == cleaned
        assert row.tokens == toks
        assert [row[c] for c in tx.FEATURE_COLUMNS] == pytest.approx(rules.style(raw, cleaned, toks), abs=1e-12)


def test_sample_lines_have_the_expected_tokens(spark):
    rows = featured(spark, HAND_WRITTEN[13:15]).orderBy("id").collect()
    assert [len(r.tokens) for r in rows] == [13, 9]


def test_repeated_mentions_give_a_ratio_between_zero_and_one(spark):
    (row,) = featured(spark, ["مركز علم مركز علم مركز ادب"]).collect()
    assert row.feature_90_entity_diversity == pytest.approx(2 / 3)


def test_folding_the_lists_makes_dead_entries_count(spark):
    text = ["على البيت إلى حتى أعتقد وزارة العلم"]
    (plain,) = featured(spark, text).collect()
    (folded,) = featured(spark, text, lx.ARABIC.folded()).collect()
    # 'علي' and 'الي' stay tokens of the plain profile and are stop words of the folded one.
    assert "علي" in plain.tokens and "علي" not in folded.tokens
    assert (plain.feature_50_prepositions, folded.feature_50_prepositions) == (0, 1)
    assert (plain.feature_70_first_person, folded.feature_70_first_person) == (1, 1)
    assert folded.feature_90_entity_diversity == 1.0


def test_other_scripts_need_only_a_profile(spark):
    (row,) = featured(spark, ["Grüße, World? 42 ok"], lx.LATIN).collect()
    assert row.clean_text == "grüße world ok"
    assert row.feature_30_question_marks == 1


def test_single_rules(spark):
    row = spark.createDataFrame([("عِلْـم  \u001c ؤ x",)], "t string").select(
        tx.strip_diacritics(F.col("t")).alias("f1"),
        tx.fold_letters(F.col("t")).alias("f2"),
        tx.drop_tatweel(F.col("t")).alias("f3"),
        tx.keep_script(F.col("t")).alias("f4"),
        tx.collapse_spaces(F.col("t")).alias("f5"),
    ).first()
    assert row.f1 == "علـم  \u001c ؤ x"
    assert row.f2 == "عِلْـم  \u001c و x"
    assert row.f3 == "عِلْم  \u001c ؤ x"
    assert row.f4 == "عِلْـم ؤ "
    assert row.f5 == "عِلْـم ؤ x"


def test_arrays(spark):
    rows = spark.createDataFrame([([],), (["a"],), (["b", "a", "b"],), (None,)], "t array<string>")
    got = rows.select(tx.term_counts(F.col("t")).alias("c"), tx.bigrams(F.col("t")).alias("b")).collect()
    assert [[(x.term, x.tf) for x in r.c] for r in got] == [[], [("a", 1)], [("a", 1), ("b", 2)], []]
    assert [r.b for r in got] == [[], [], ["b a", "a b"], None]


def test_no_python_in_the_plan(spark):
    plan = plan_of(featured(spark, ["x"]))
    assert "EvalPython" not in plan and "MapInPandas" not in plan
