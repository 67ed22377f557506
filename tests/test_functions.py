import unicodedata

import pytest
from pyspark.sql import functions as F

from millrace.functions import similarity as S
from millrace.functions import text as T


def one(spark, expr, *args):
    df = spark.createDataFrame([tuple(args)], ", ".join(f"c{i} string" for i in range(len(args))))
    return df.select(expr(*(F.col(f"c{i}") for i in range(len(args)))).alias("x")).first().x


def test_golden_values(spark):
    assert one(spark, S.token_jaccard, "a b c", "b c d") == 0.5
    assert one(spark, S.token_jaccard, "", "") == 1.0 and one(spark, S.token_jaccard, "a", "") == 0.0
    assert one(spark, S.edit_similarity, "hello", "hello") == 1.0 and one(spark, S.edit_similarity, "", "hello") == 0.0 and one(spark, S.edit_similarity, "", "") == 1.0
    assert one(spark, S.length_ratio, "hi", "hello") == pytest.approx(0.4)
    assert one(spark, S.containment, "a b", "b c") == 0.5 and one(spark, S.containment, "", "b") == 0.0
    assert one(spark, S.char_jaccard, "ab", "bc") == pytest.approx(1 / 3)
    assert one(spark, S.edit_similarity, "café", "cafe") == 0.75


def test_normalisation(spark):
    for norm in (T.normalize_v1, T.normalize_v3):
        assert one(spark, norm, "  Hello  World  ") == "hello world"
        assert one(spark, norm, None) == "" and one(spark, norm, "   ") == ""
    assert one(spark, T.normalize_v1, "Ｆｕｌｌ ﬁne, O'Neil") == "full fine o neil"
    assert one(spark, T.normalize_v1, "Écóle") == "école" or unicodedata.normalize("NFKC", "Écóle").lower() == one(spark, T.normalize_v1, "Écóle")
    assert one(spark, T.normalize_v3, "Groupe de la Rue Boulevard") == "st blvd"
    assert one(spark, T.clean_nlp, "a\x00b  c") == "ab c" and one(spark, T.clean_etl, None) is None


@pytest.mark.parametrize(("word", "code"), [("Pfister", "P123"), ("Tymczak", "T520"), ("", ""), ("1bob", "1000"), ("école", "É240"), ("Robert", "R163"), ("a", "A000")])
def test_phonetic(spark, word, code):
    assert one(spark, T.phonetic, word) == code


def test_extracts(spark):
    assert one(spark, T.zip_code, "12 main st 75001 paris 123456") == "75001" and one(spark, T.zip_code, None) == ""
    assert one(spark, T.po_box, "p o box 12 x") == "p o box 12"
    assert one(spark, T.strip_suffix, "acme group ltd") == "acme" and one(spark, T.expand_abbreviations, "intl tech x") == "international technology x"
    assert one(spark, T.sorted_tokens, "b a") == "a b" and one(spark, T.char_trigrams, "Ab cde") == [" ab", "ab ", " cd", "cde", "de "]
    assert one(spark, T.char_trigrams, "a") == [" a "] and one(spark, T.char_trigrams, None) == []


def plain_lcs(a, b):
    a, b = (a or "")[:200], (b or "")[:200]
    if not a or not b:
        return 0.0
    best = max((n for i in range(len(a)) for n in range(1, len(a) - i + 1) if a[i : i + n] in b), default=0)
    return best / max(len(a), len(b))


def test_substring_ratio(spark):
    rows = [("abcdef", "zabcy"), ("", "a"), (None, "a"), ("héllo", "hell"), ("same", "same"), ("x" * 300, "x" * 250), ("ab" * 40, "ba" * 30)]
    df = spark.createDataFrame(rows, "a string, b string").select("a", "b", S.substring_ratio(F.col("a"), F.col("b")).alias("x"))
    assert [r.x for r in df.collect()] == [pytest.approx(plain_lcs(a, b)) for a, b in rows]


def test_sql_functions(spark):
    S.register(spark)
    assert spark.sql("select nfkc('ﬁ') as a, lcs_ratio('abc', 'xbc') as b").first().asDict() == {"a": "fi", "b": pytest.approx(2 / 3)}
