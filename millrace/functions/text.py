"""Text functions, Column to Column. All are JVM built-ins but nfkc, an Arrow UDF (Spark has no Unicode normaliser)."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.functions.constants import ABBREVIATIONS, BUSINESS_SUFFIXES, FRENCH_REPLACEMENTS, FRENCH_STOP_WORDS, PHONETIC_CODES


@F.arrow_udf(StringType())
def _nfkc(text: pa.Array) -> pa.Array:
    if pc.all(pc.string_is_ascii(text)).as_py() is not False:
        return text
    return pa.array([t if t is None or t.isascii() else unicodedata.normalize("NFKC", t) for t in text.to_pylist()], pa.string())


def nfkc(text: Column) -> Column:
    """Unicode compatibility normalisation; null stays null."""
    return _nfkc(text)


def _set(words: list[str]) -> Column:
    return F.array(*(F.lit(w) for w in words))


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv))


def collapse(text: Column) -> Column:
    """Runs of Unicode white space become one blank; ends are stripped."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def words(text: Column) -> Column:
    """Tokens between blanks, in order; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), " "), lambda w: w != "")


def normalize_v1(text: Column, unicode_form: bool = True) -> Column:
    """NFKC, lower case, marks to blanks, blanks collapsed; null or blank gives ''."""
    text = F.coalesce(text, F.lit(""))
    text = nfkc(text) if unicode_form else text
    return collapse(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_\s]", " "))


def normalize_v3(text: Column, unicode_form: bool = True) -> Column:
    """normalize_v1, then French stop words dropped and tokens replaced."""
    kept = F.filter(words(normalize_v1(text, unicode_form)), lambda w: ~F.array_contains(_set(FRENCH_STOP_WORDS), w))
    return F.array_join(F.transform(kept, lambda w: F.coalesce(F.element_at(_map(FRENCH_REPLACEMENTS), w), w)), " ")


def normalize_entities(df: DataFrame, profile: str = "v3", unicode_form: bool = True, columns: tuple[str, ...] = ("business_name", "business_address", "country")) -> DataFrame:
    """Adds <column>_norm for those columns that df has."""
    norm = {"v1": normalize_v1, "v2": normalize_v1, "v3": normalize_v3}[profile]
    return df.withColumns({f"{c}_norm": norm(F.col(c), unicode_form) for c in columns if c in df.columns})


def clean_etl(text: Column, unicode_form: bool = True) -> Column:
    """NFKC and collapsed white space; null stays null."""
    return collapse(nfkc(text) if unicode_form else text)


def clean_nlp(text: Column, unicode_form: bool = True) -> Column:
    """NFKC, control characters removed, white space collapsed; null gives ''."""
    text = F.coalesce(text, F.lit(""))
    text = nfkc(text) if unicode_form else text
    return collapse(F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]", ""))


def normalize_text(text: Column, lowercase: bool = True, unicode_form: bool = True) -> Column:
    text = clean_nlp(text, unicode_form)
    return F.lower(text) if lowercase else text


def batch_clean(df: DataFrame, column: str, unicode_form: bool = True) -> DataFrame:
    return df.withColumn(f"{column}_clean", clean_nlp(F.col(column), unicode_form))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"(?U)\S+")), F.lit(0))


def text_features(df: DataFrame, column: str) -> DataFrame:
    """Adds <column>_char_len, _word_count, _has_digits, _has_upper, _unique_words; null counts as ''."""
    t = F.coalesce(F.col(column), F.lit(""))
    unique = F.size(F.array_distinct(words(collapse(F.lower(t)))))
    return df.withColumns({
        f"{column}_char_len": F.length(t), f"{column}_word_count": word_count(t), f"{column}_has_digits": t.rlike(r"(?U)\d").cast("int"),
        f"{column}_has_upper": t.rlike("[A-Z]").cast("int"), f"{column}_unique_words": unique,
    })


def text_features_basic(df: DataFrame, column: str) -> DataFrame:
    """Adds <column>_len, _word_count, _char_count (characters that aren't white space)."""
    t = F.coalesce(F.col(column), F.lit(""))
    return df.withColumns({f"{column}_len": F.length(t), f"{column}_word_count": word_count(t), f"{column}_char_count": F.length(F.regexp_replace(t, r"(?U)\s+", ""))})


def tokens(text: Column) -> Column:
    """Distinct tokens."""
    return F.array_distinct(words(text))


def numeric_tokens(text: Column) -> Column:
    """Distinct runs of digits."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)(\d+)")))


def alpha_tokens(text: Column) -> Column:
    """Distinct tokens of letters only."""
    return F.filter(tokens(text), lambda t: t.rlike(r"^\p{L}+$"))


def phonetic(text: Column) -> Column:
    """First character kept, then codes of later letters that differ from the code before; letters without a code are skipped
    and do not part equal codes; four characters, filled with 0; '' for ''."""
    up = F.upper(F.coalesce(text, F.lit("")))
    head = F.substring(up, 1, 1)
    tail = F.substring(up, 2, 1 << 30)
    letters, codes = "".join(PHONETIC_CODES), "".join(c * len(k) for k, c in PHONETIC_CODES.items())
    coded = F.regexp_replace(F.translate(F.regexp_replace(tail, r"[0-9]", ""), letters, codes), r"[^1-6]", "")
    coded = F.regexp_replace(coded, r"([1-6])\1+", "$1")
    coded = F.when(F.substring(coded, 1, 1) == head, F.substring(coded, 2, 1 << 30)).otherwise(coded)
    return F.when(up == "", F.lit("")).otherwise(F.rpad(F.concat(head, coded), 4, "0"))


def zip_code(text: Column) -> Column:
    """First run of five or six digits that stands alone, or ''."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), r"\b(\d{5,6})\b", 1)


def po_box(text: Column) -> Column:
    return F.regexp_extract(F.coalesce(text, F.lit("")), r"(p\s*o\s*box\s*\d+)", 1)


def strip_suffix(text: Column) -> Column:
    return F.array_join(F.filter(words(text), lambda w: ~F.array_contains(_set(BUSINESS_SUFFIXES), w)), " ")


def expand_abbreviations(text: Column) -> Column:
    return F.array_join(F.transform(words(text), lambda w: F.coalesce(F.element_at(_map(ABBREVIATIONS), w), w)), " ")


def sorted_tokens(text: Column) -> Column:
    return F.array_join(F.array_sort(words(text)), " ")


def char_trigrams(text: Column) -> Column:
    """All 3-grams of each lower-cased word with a blank on either side; a padded word of three characters or fewer once."""
    padded = F.transform(words(collapse(F.lower(F.coalesce(text, F.lit(""))))), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))
    return F.flatten(F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - 2, F.lit(1))), lambda i: F.substring(w, i, F.lit(3)))))


def pair_prompt(name1: Column, address1: Column, country1: Column, name2: Column, address2: Column, country2: Column) -> Column:
    """Question to a language model whether two records are one entity; the fields are normalised first (normalize_v1)."""
    record = lambda *fields: F.concat_ws(", ", *(F.concat(F.lit(f"{k}: "), normalize_v1(x)) for k, x in zip(("name", "address", "country"), fields, strict=True)))
    return F.concat(F.lit("Do these two records describe the same business?\nA: "), record(name1, address1, country1), F.lit("\nB: "), record(name2, address2, country2), F.lit("\nAnswer Yes or No: "))
