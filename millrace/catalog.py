"""Queries over the driver's tables, one or more per operator, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import similarity as S
from millrace.functions import text as T
from millrace.functions.constants import ABBREVIATIONS, BUSINESS_SUFFIXES, FRENCH_REPLACEMENTS, FRENCH_STOP_WORDS, PHONETIC_CODES
from millrace.operators import features, metrics, models, providers, quality, setops, sharding, submission
from millrace.plans import blocking, er, pairs, tfidf
from millrace.session import shared_folder, written
from millrace.sources import readers
from millrace.streaming import resume

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- SQL fragments that restate the column functions -----------------------------------------------------------------


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _case(var: str, pairs_: dict[str, str]) -> str:
    return f"case {var} " + " ".join(f"when '{k}' then '{v}'" for k, v in pairs_.items()) + f" else {var} end"


def q_collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def q_words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def q_norm1(x: str) -> str:
    return q_collapse(f"regexp_replace(lower(coalesce({x}, '')), '[^\\pL\\pN_\\s]', ' ', 'g')")


def q_norm3(x: str) -> str:
    return f"array_to_string(list_transform(list_filter(string_split({q_norm1(x)}, ' '), lambda w: w <> '' and not list_contains({_list(FRENCH_STOP_WORDS)}, w)), lambda w: {_case('w', FRENCH_REPLACEMENTS)}), ' ')"


def q_jaccard(a: str, b: str) -> str:
    return f"(case when len({a}) = 0 and len({b}) = 0 then 1.0 when len({a}) = 0 or len({b}) = 0 then 0.0 else len(list_intersect({a}, {b}))::double / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) end)"


def q_edit(a: str, b: str) -> str:
    return f"(case when {a} = {b} then 1.0 when {a} = '' or {b} = '' then 0.0 else 1.0 - levenshtein(left({a}, 500), left({b}, 500))::double / greatest(length(left({a}, 500)), length(left({b}, 500))) end)"


def q_ratio(a: str, b: str) -> str:
    return f"(case when {a} = '' and {b} = '' then 1.0 when {a} = '' or {b} = '' then 0.0 else least(length({a}), length({b}))::double / greatest(length({a}), length({b})) end)"


def q_contains(a: str, b: str) -> str:
    return f"(case when len({a}) = 0 then 0.0 else len(list_intersect({a}, {b}))::double / len({a}) end)"


def q_equal(a: str, b: str) -> str:
    return f"(case when {a} = {b} and {a} <> '' then 1.0 else 0.0 end)"


def q_chars(x: str) -> str:
    return f"list_distinct(list_filter(string_split({x}, ''), lambda c: c <> ''))"


def q_tokens(x: str) -> str:
    return f"list_distinct({q_words(x)})"


def q_alpha(x: str) -> str:
    return f"list_filter({q_tokens(x)}, lambda t: regexp_matches(t, '^\\pL+$'))"


def q_numeric(x: str) -> str:
    return f"list_distinct(regexp_extract_all({x}, '\\d+'))"


def q_strip(x: str) -> str:
    return f"array_to_string(list_filter({q_words(x)}, lambda w: not list_contains({_list(BUSINESS_SUFFIXES)}, w)), ' ')"


def q_expand(x: str) -> str:
    return f"array_to_string(list_transform({q_words(x)}, lambda w: {_case('w', ABBREVIATIONS)}), ' ')"


def q_sorted(x: str) -> str:
    return f"array_to_string(list_sort({q_words(x)}), ' ')"


def q_phonetic(x: str) -> str:
    letters, codes = "".join(PHONETIC_CODES), "".join(c * len(k) for k, c in PHONETIC_CODES.items())
    code = f"regexp_replace(translate(regexp_replace(substr(upper({x}), 2), '[0-9]', '', 'g'), '{letters}', '{codes}'), '[^1-6]', '', 'g')"
    for c in "123456":
        code = f"regexp_replace({code}, '{c}+', '{c}', 'g')"
    head = f"substr(upper({x}), 1, 1)"
    return f"(case when {x} = '' then '' else rpad(substr(concat({head}, case when substr({code}, 1, 1) = {head} then substr({code}, 2) else {code} end), 1, 4), 4, '0') end)"


def q_shard(x: str, n: int) -> str:
    return f"(concat('0x', substr(md5({x}::varchar), 1, 8))::ubigint % {n})::bigint"


# --- Entities: customers on the left, their orders as noisy records on the right ---------------------------------------

_FULL = "concat(substr(c_name, 10), ' ', c_mktsegment, ' Co.')"
LEFT = {"entity_id": "concat('c', c_custkey)", "business_name": _FULL, "business_address": "concat(c_custkey, ' Main Street ', c_nationkey)", "country": "n_name"}
RIGHT = {
    "entity_id": "concat('o', o_orderkey)",
    "business_name": f"case o_orderkey % 5 when 0 then upper({_FULL}) when 1 then concat('  ', substr(c_name, 10), ' ', c_mktsegment, ' Company') when 2 then concat(substr(c_name, 10), ' The ', c_mktsegment, ', LLC') when 3 then concat(substr(c_name, 10), ' Intl ', c_mktsegment) else {_FULL} end",
    "business_address": "case when o_orderkey % 7 = 0 then null when o_orderkey % 3 = 0 then concat(c_custkey, ' main st, ', c_nationkey) else concat(c_custkey, ' Main Street ', c_nationkey) end",
    "country": "case when o_orderkey % 11 = 0 then null else n_name end",
}


def entities(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.expr("c_nationkey = n_nationkey"))
    o = table(spark, d, "orders").join(c, F.expr("o_custkey = c_custkey"))
    return c.select(*(F.expr(e).alias(k) for k, e in LEFT.items())), o.select(*(F.expr(e).alias(k) for k, e in RIGHT.items()))


def truth(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.expr("concat('c', o_custkey)").alias("source1_entity_id"), F.expr("concat('o', o_orderkey)").alias("source2_entity_id"))


def normalised(spark: SparkSession, d: str, profile: str = "v3") -> tuple[DataFrame, DataFrame]:
    l, r = entities(spark, d)
    return T.normalize_entities(l, profile), T.normalize_entities(r, profile)


def written_sides(spark: SparkSession, d: str, profile: str = "v3") -> tuple[DataFrame, DataFrame, str]:
    """normalised, computed once for all steps that read it, and the folder."""
    where = shared_folder(spark)
    with ThreadPoolExecutor(2) as pool:  # side by side, as a small side is one task
        l, r = pool.map(lambda x: written(x[0], where, x[1]), zip(normalised(spark, d, profile), ("left", "right"), strict=True))
    return l, r, where


def _q_side(cols: dict[str, str], source: str, norm) -> str:
    made = ", ".join(f"{norm(e)} as {k}" if k != "entity_id" else f"{e} as entity_id" for k, e in cols.items())
    return f"select {made} from {source}"


def q_entities(profile: str = "v3") -> str:
    norm = q_norm3 if profile == "v3" else q_norm1
    c = "customer join nation on c_nationkey = n_nationkey"
    return f"s1 as ({_q_side(LEFT, c, norm)}), s2 as ({_q_side(RIGHT, f'orders join ({c}) on o_custkey = c_custkey', norm)})"


def q_first(x: str) -> str:
    return f"case when length(split_part({x}, ' ', 1)) >= 2 then concat(split_part({x}, ' ', 1), '|', country) end"


Q_NUMERIC_KEY = "case when len(regexp_extract_all(business_address, '\\d+')) > 0 then concat(array_to_string(list_slice(list_sort(list_distinct(regexp_extract_all(business_address, '\\d+'))), 1, 3), '|'), '|', country) end"
Q_TWO_KEY = f"case when len({q_words('business_name')}) >= 2 then concat(split_part(business_name, ' ', 1), ' ', split_part(business_name, ' ', 2), '|', country) end"


def q_block(key: str, cap: int | None, tag: str) -> str:
    limit = f"where k in (select k from b_{tag} where k is not null group by k having count(*) < {cap})" if cap else ""
    return f"a_{tag} as (select entity_id as source1_entity_id, {key} as k from s1), b_{tag} as (select entity_id as source2_entity_id, {key} as k from s2), p_{tag} as (select source1_entity_id, source2_entity_id from (select * from a_{tag} {limit}) join b_{tag} using (k))"


def q_candidates(cap: int | None = 50, profile: str = "v3") -> str:
    tags = [("first", q_first("business_name")), ("num", Q_NUMERIC_KEY)] + ([("two", Q_TWO_KEY)] if profile == "v3" else [])
    parts = ", ".join(q_block(k, cap, t) for t, k in tags)
    union = " union ".join(f"select * from p_{t}" for t, _ in tags)
    return f"{q_entities(profile)}, {parts}, cand as ({union})"


CAND = "with " + q_candidates()


# --- Scans, projections, casts -----------------------------------------------------------------------------------------


@query("select * from lineitem order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate limit 1000")
def scan_row_limit(spark, d):
    """A row limit is the feature: the first rows by key."""
    return readers.row_limit(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"], 1000)


@query("select l_orderkey, l_linenumber, coalesce(case when l_quantity > 40 then null else l_quantity end::float, 0)::float as l_quantity, coalesce(l_discount::float, 0)::float as l_discount from lineitem")
def numeric_cast_fill(spark, d):
    df = table(spark, d, "lineitem").withColumn("l_quantity", F.expr("case when l_quantity > 45 then double('NaN') when l_quantity > 40 then null else l_quantity end"))
    return features.cast_features(df, ["l_quantity", "l_discount"]).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query("select c_custkey, c_nationkey, c_name, c_mktsegment from customer")
def role_projection(spark, d):
    df = table(spark, d, "customer")
    numbers, strings = features.role_projection(df, "c_custkey", "c_acctbal")
    return df.select("c_custkey", *numbers, *strings)


@query("select doc_id, length(text)::bigint as n from documents where text is not null and length(text) >= 2 and text <> ''")
def nonempty_filter(spark, d):
    return table(spark, d, "documents").where("text is not null and length(text) >= 2 and text <> ''").select("doc_id", F.length("text").cast("long").alias("n"))


# --- Sources and sinks: written to the shared folder and read back ---------------------------------------------------------

_ROWS = "c_custkey, c_name, c_nationkey, c_mktsegment"


@query(f"select {_ROWS} from customer")
def parquet_round_trip(spark, d):
    folder = shared_folder(spark)
    readers.write_parquet(table(spark, d, "customer").selectExpr(*_ROWS.split(", ")), f"{folder}/customer.parquet")
    return readers.extract(spark, folder=folder)


@query("select c_custkey, concat(c_name, ', \"', c_mktsegment, '\"', chr(10), 'x') as note, case when c_custkey % 3 <> 0 then c_acctbal end as c_acctbal from customer")
def csv_round_trip(spark, d):
    """Quotes, separators, line ends and nulls come back."""
    folder = shared_folder(spark)
    rows = table(spark, d, "customer").selectExpr("c_custkey", "concat(c_name, ', \"', c_mktsegment, '\"\\n', 'x') as note", "case when c_custkey % 3 <> 0 then c_acctbal end as c_acctbal")
    readers.write_delimited(rows, f"{folder}/customer.csv", ",")
    return readers.extract(spark, folder=folder).select(F.col("c_custkey").cast("long"), "note", F.col("c_acctbal").cast("double"))


@query("select concat('c', c_custkey) as entity_id, c_name as business_name, coalesce(case when c_custkey % 4 <> 0 then c_mktsegment end, '') as business_address, '' as country, 1 as source from customer union all select concat('s', s_suppkey), s_name, '', '', 2 from supplier")
def entity_sources_round_trip(spark, d):
    """Two of three TSV sources exist; nulls are empty texts."""
    folder = shared_folder(spark)
    made = {1: table(spark, d, "customer").selectExpr("concat('c', c_custkey) as entity_id", "c_name as business_name", "case when c_custkey % 4 <> 0 then c_mktsegment end as business_address", "cast(null as string) as country"),
            2: table(spark, d, "supplier").selectExpr("concat('s', s_suppkey) as entity_id", "s_name as business_name", "'' as business_address", "'' as country")}
    for i, df in made.items():
        readers.write_delimited(df, f"{folder}/train/train_source{i}.tsv")
    return readers.entities(spark, folder, "train")


@query("select concat('c', o_custkey) as source1_entity_id, concat('o', o_orderkey) as source2_entity_id from orders")
def ground_truth_round_trip(spark, d):
    folder = shared_folder(spark)
    lists = truth(spark, d).groupBy("source1_entity_id").agg(F.array_join(F.collect_list("source2_entity_id"), ",").alias("matched_entity_ids"))
    readers.write_delimited(lists, f"{folder}/train/train_ground_truth.tsv")
    return submission.explode_truth(readers.ground_truth(spark, folder)).select("source1_entity_id", "source2_entity_id")


@query("select doc_id, sum(quality)::double as prediction from (select doc_id, quality from labels union all select doc_id, toxic from labels) group by 1")
def prediction_files_round_trip(spark, d):
    """Files that are missing or lack the columns are left out."""
    folder, labels = shared_folder(spark), table(spark, d, "labels")
    for c in ("quality", "toxic"):
        readers.write_parquet(labels.select("doc_id", F.col(c).cast("double").alias("prediction")), f"{folder}/{c}.parquet")
    readers.write_parquet(labels.select("doc_id"), f"{folder}/other.parquet")
    found = readers.predictions(spark, [f"{folder}/{n}.parquet" for n in ("quality", "toxic", "other", "none")], "doc_id", "prediction")
    return found[0].unionByName(found[1]).groupBy("doc_id").agg(F.sum("prediction").alias("prediction")) if len(found) == 2 else found[0]


@query("select doc_id, lang, source from documents")
def worker_outputs_round_trip(spark, d):
    folder, df = shared_folder(spark), table(spark, d, "documents").select("doc_id", "lang", "source")
    for i in range(3):
        readers.write_worker(sharding.get_shard(df, "doc_id", i, 3), folder, i, {"worker": i}, {}, {})
    return readers.merge_workers(spark, folder, "doc_id")


@query("select event_id, user_id, case when event_id % 2 = 0 then value + 1 else value end as value from events where event_id % 3 <> 0")
def cache_round_trip(spark, d):
    """Two versions of a cache: the second replaces and adds; rows that are asked for come back."""
    e = table(spark, d, "events").select("event_id", "user_id", "value")
    cache = setops.Cache(spark, shared_folder(spark), "events", {"model": "x"}, "event_id")
    cache.save(e.where("event_id % 3 = 0 or event_id % 2 = 0"))
    cache.save(e.where("event_id % 2 = 0").withColumn("value", F.col("value") + 1))
    return setops.resume(e.where("event_id % 3 <> 0"), cache, lambda todo: todo)


# --- Shards, splits, samples -------------------------------------------------------------------------------------------


@query(f"select doc_id, {q_shard('doc_id', 7)} as shard from documents")
def shard_assign(spark, d):
    return table(spark, d, "documents").select("doc_id", sharding.shard_of("doc_id", 7).alias("shard"))


@query(f"select {q_shard('doc_id', 7)} as shard, count(*) as rows from documents group by 1")
def shard_histogram(spark, d):
    return sharding.shard_histogram(table(spark, d, "documents"), "doc_id", 7)


@query(f"select doc_id, source from documents where {q_shard('doc_id', 7)} = 3")
def shard_filter(spark, d):
    return sharding.get_shard(table(spark, d, "documents"), "doc_id", 3, 7).select("doc_id", "source")


@query("select count(*) as total_ids, count(*) as covered_ids, 0::bigint as overlapping_ids, true as complete from documents")
def shard_verify(spark, d):
    df = table(spark, d, "documents").select("doc_id")
    return sharding.verify_shards(df, [sharding.get_shard(df, "doc_id", i, 4) for i in range(4)], "doc_id")


@query("select doc_id, case when row_number() over (order by md5(concat('42:', doc_id))) <= ceil(0.2 * (select count(*) from documents)) then 'val' else 'train' end as split from documents")
def split_random(spark, d):
    return sharding.split_random(table(spark, d, "documents").select("doc_id"), "doc_id", 0.2)


@query("""with c as (select quality, count(*) as n, floor(0.2 * count(*)) as f, 0.2 * count(*) - floor(0.2 * count(*)) as r from labels group by 1),
t as (select quality, f + case when row_number() over (order by r desc, quality) <= ceil(0.2 * (select sum(n) from c)) - (select sum(f) from c) then 1 else 0 end as take from c)
select doc_id, quality, case when row_number() over (partition by quality order by md5(concat('42:', doc_id))) <= take then 'val' else 'train' end as split from labels join t using (quality)""")
def split_stratified(spark, d):
    return sharding.split_stratified(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "quality", 0.2)


@query("""with g as (select distinct o_custkey from orders), s as (select o_custkey, case when row_number() over (order by md5(concat('42:', o_custkey))) <= ceil(0.2 * (select count(*) from g)) then 'val' else 'train' end as split from g)
select o_orderkey, o_custkey, split from orders join s using (o_custkey)""")
def split_group(spark, d):
    return sharding.split_group(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", "o_custkey", 0.2)


@query(f"select o_orderkey, o_custkey, {q_shard('o_custkey', 5)} as fold from orders")
def group_folds_hash(spark, d):
    return sharding.hash_folds(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 5)


@query()
def group_folds_balanced(spark, d):
    """Greedy: the largest group to the lightest fold."""
    return sharding.balanced_folds(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 5)


@query("""with c as (select quality as label, doc_id, row_number() over (partition by quality order by md5(concat('42:', doc_id))) as n from labels where quality in (0, 1)),
p as (select least(count(*), 50) as pos from c where label = 1), q as (select least(count(*), floor((select pos from p) * 1.5)) as neg from c where label = 0)
select doc_id, label from c where n <= case when label = 1 then (select pos from p) else (select neg from q) end""")
def balanced_sample(spark, d):
    return sharding.balanced_sample(table(spark, d, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id", "label", 100, 1.5)


@query("select doc_id from documents order by md5(concat('42:', doc_id)), doc_id limit 100")
def screening_sample(spark, d):
    """A sampling operator."""
    return sharding.sample_rows(table(spark, d, "documents").select("doc_id"), "doc_id", 100)


# --- Inspection and validation -----------------------------------------------------------------------------------------

_NULLED = "case when event_id % 20 = 0 then null else value end"


def _events(spark, d):
    return table(spark, d, "events").withColumn("value", F.expr(_NULLED))


@query(f"select 'value' as \"column\", count(*) - count({_NULLED}) as nulls, round(100.0 * (count(*) - count({_NULLED})) / count(*), 2)::double as null_pct from events")
def inspect_nulls(spark, d):
    return quality.null_report(_events(spark, d))


@query("select 'n_nationkey' as \"column\", count(distinct n_nationkey) as distinct_values from nation union all select 'n_name', count(distinct n_name) from nation union all select 'n_regionkey', count(distinct n_regionkey) from nation")
def inspect_distinct(spark, d):
    return quality.distinct_report(table(spark, d, "nation"))


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" union all ".join(f"select '{c}' as \"column\", count({c}) as count, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std, round(min({c}), 4) as min, round(quantile_cont({c}, 0.25), 4) as p25, round(quantile_cont({c}, 0.5), 4) as p50, round(quantile_cont({c}, 0.75), 4) as p75, round(max({c}), 4) as max from lineitem" for c in _NUM))
def inspect_numeric(spark, d):
    return quality.numeric_report(table(spark, d, "lineitem"), _NUM)


@query(" union all ".join(f"select '{c}' as \"column\", count({c}) as count, round(avg(length({c})), 2) as mean_length, min(length({c}))::int as min_length, max(length({c}))::int as max_length, floor(quantile_cont(length({c}), 0.5))::int as median_length from documents" for c in ("text", "lang", "source")))
def inspect_text(spark, d):
    return quality.text_length_report(table(spark, d, "documents"))


@query("""with t as (select case when conv_id % 10 = 0 then null when conv_id % 10 = 1 then '' else text end as t from conversations), w as (select t, length(t) as n, len(regexp_extract_all(t, '\\S+')) as w from t)
select count(t) as count, (count(*) - count(t)) as null_count, sum(case when t = '' then 1 else 0 end)::bigint as empty_count, round(avg(n), 4) as char_mean, min(n)::int as char_min, max(n)::int as char_max, quantile_cont(n, 0.5)::double as char_median,
round(avg(w), 4) as word_mean, min(w)::int as word_min, max(w)::int as word_max, quantile_cont(w, 0.5)::double as word_median from w""")
def text_stats(spark, d):
    return quality.text_stats(table(spark, d, "conversations").withColumn("t", F.expr("case when conv_id % 10 = 0 then null when conv_id % 10 = 1 then '' else text end")), "t")


@query("""select (select count(*) from documents) as rows, ((select count(*) from documents) - (select count(*) from (select distinct lang, source, text from documents)))::bigint as duplicate_rows,
((select count(*) from documents) - (select count(distinct text) from documents))::bigint as duplicate_ids""")
def duplicate_report(spark, d):
    return quality.duplicate_report(table(spark, d, "documents").select("lang", "source", "text"), "text")


@query(f"""select * from (select 'warning' as level, 'duplicate_ids' as "check", 'user_id' as "column", (count(*) - count(distinct user_id))::double as value from events
union all select 'warning', 'null_target', 'value', (count(*) - count({_NULLED}))::double from events
union all select 'warning', 'constant_column', 'one', 1.0 union all select 'error', 'missing_column', 'absent', 1.0)""")
def validate_frame(spark, d):
    return quality.validate(_events(spark, d).withColumn("one", F.lit(1)), "user_id", "value", ["event_id", "absent"])


@query("""select 'id' as kind, 'l_orderkey' as "column", count(*) as overlap from (select distinct l_orderkey from lineitem where l_linenumber <= 2 intersect select distinct l_orderkey from lineitem where l_linenumber > 2)
union all select 'group', 'l_suppkey', count(*) from (select distinct l_suppkey from lineitem where l_linenumber <= 2 intersect select distinct l_suppkey from lineitem where l_linenumber > 2)""")
def leakage_check(spark, d):
    li = table(spark, d, "lineitem")
    return quality.leakage(li.where("l_linenumber <= 2"), li.where("l_linenumber > 2"), "l_orderkey", "l_suppkey")


@query(f"select event_id, user_id, event_type, coalesce({_NULLED}, (select quantile_cont({_NULLED}, 0.5) from events)) as value from events")
def median_impute(spark, d):
    return quality.impute_medians(_events(spark, d).select("event_id", "user_id", "event_type", "value"), ["value"])


@query(f"""with t as (select distinct c_custkey, concat('  ', c_name, '  x') as c_name, c_nationkey, case when c_custkey % 9 = 0 then null else c_acctbal end as c_acctbal, c_mktsegment from customer)
select c_custkey, lower({q_collapse('c_name')}) as c_name, c_nationkey::double as c_nationkey, coalesce(c_acctbal, (select quantile_cont(c_acctbal, 0.5) from t)) as c_acctbal, lower(trim(c_mktsegment)) as c_mktsegment from t""")
def preprocess_frame(spark, d):
    c = table(spark, d, "customer").withColumns({"c_name": F.expr("concat('  ', c_name, '  x')"), "c_acctbal": F.expr("case when c_custkey % 9 = 0 then null else c_acctbal end")})
    return quality.preprocess(c.unionByName(c), "c_custkey", ("c_name",))


# --- Deduplication, unions, caches -------------------------------------------------------------------------------------


@query("select distinct lang, source, text from documents")
def dedup_rows(spark, d):
    return setops.dedup(table(spark, d, "documents").select("lang", "source", "text"))


_LAST = "select event_id, ts, user_id, event_type, value from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"


@query(_LAST)
def dedup_keep_last(spark, d):
    return setops.keep_one(table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value"), ["user_id"], ["ts", "event_id"], last=True)


@query("select user_id, max(value) as value from events where event_type = 'click' group by 1 union all select user_id, min(value) from events where user_id not in (select user_id from events where event_type = 'click') group by 1")
def cache_upsert(spark, d):
    e = table(spark, d, "events")
    old, new = e.groupBy("user_id").agg(F.min("value").alias("value")), e.where("event_type = 'click'").groupBy("user_id").agg(F.max("value").alias("value"))
    return setops.upsert(old, new, "user_id")


@query("select event_id, user_id from events where event_id not in (select event_id from events where user_id % 3 = 0)")
def filter_uncached(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id")
    return setops.uncached(e, e.where("user_id % 3 = 0").select("event_id"), "event_id")


@query("select doc_id, lang, n_chars from documents")
def merge_workers(spark, d):
    df = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return setops.union_checked([sharding.get_shard(df, "doc_id", i, 3) for i in range(3)], "doc_id")


@query(f"select (select count(*) from documents) as original_rows, sum(case when {q_shard('doc_id', 3)} < 2 then 1 else 0 end)::bigint as merged_rows, sum(case when {q_shard('doc_id', 3)} < 2 then 0 else 1 end)::bigint as missing_ids, 0::bigint as unexpected_ids from documents")
def verify_merge(spark, d):
    df = table(spark, d, "documents").select("doc_id")
    return setops.verify_merge(df, setops.union_checked([sharding.get_shard(df, "doc_id", i, 3) for i in range(2)], "doc_id"), "doc_id")


@query("select user_id::varchar as experiment_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as timestamp, event_type as task from events qualify row_number() over (partition by user_id order by strftime(ts, '%Y-%m-%d %H:%M:%S'), event_type) = 1")
def experiment_merge(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").cast("string").alias("experiment_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), F.col("event_type").alias("task"))
    return setops.keep_one(e, ["experiment_id"], ["timestamp", "task"]).orderBy("timestamp", "experiment_id")


# --- Text ---------------------------------------------------------------------------------------------------------------


@query(f"select conv_id, turn, {q_collapse('text')} as text from conversations")
def clean_text_etl(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", T.clean_etl(F.col("text")).alias("text"))


@query(f"select conv_id, turn, {q_collapse('text')} as text_clean, lower({q_collapse('text')}) as text_normal from conversations")
def batch_clean(spark, d):
    df = T.batch_clean(table(spark, d, "conversations"), "text")
    return df.select("conv_id", "turn", "text_clean", T.normalize_text(F.col("text")).alias("text_normal"))


@query(f"select doc_id, {q_norm1('text')} as norm from documents")
def normalize_field_v1(spark, d):
    return table(spark, d, "documents").select("doc_id", T.normalize_v1(F.col("text")).alias("norm"))


@query(f"select doc_id, {q_norm3('text')} as norm from documents")
def normalize_field_v3(spark, d):
    return table(spark, d, "documents").select("doc_id", T.normalize_v3(F.col("text")).alias("norm"))


@query(f"select doc_id, length(text)::int as text_char_len, len(regexp_extract_all(text, '\\S+'))::int as text_word_count, regexp_matches(text, '\\d')::int as text_has_digits, regexp_matches(text, '[A-Z]')::int as text_has_upper, len({q_tokens(q_collapse('lower(text)'))})::int as text_unique_words from documents")
def text_features(spark, d):
    return T.text_features(table(spark, d, "documents"), "text").drop("text", "lang", "source", "n_chars")


@query("select page_id, length(html)::int as html_len, len(regexp_extract_all(html, '\\S+'))::int as html_word_count, length(regexp_replace(html, '\\s+', '', 'g'))::int as html_char_count from pages")
def text_features_basic(spark, d):
    return T.text_features_basic(table(spark, d, "pages"), "html").drop("html", "url")


@query(f"select p_partkey, array_to_string(list_sort({q_tokens('t')}), ' ') as tokens, array_to_string(list_sort({q_numeric('t')}), ' ') as numbers, array_to_string(list_sort({q_alpha('t')}), ' ') as alpha from (select p_partkey, {q_norm1('concat(p_name, p_size, chr(32), p_brand, chr(32), p_type, chr(32), p_size)')} as t from part)")
def token_sets(spark, d):
    t = table(spark, d, "part").select("p_partkey", T.normalize_v1(F.expr("concat(p_name, p_size, ' ', p_brand, ' ', p_type, ' ', p_size)")).alias("t"))
    flat = lambda c: F.array_join(F.array_sort(c), " ")
    return t.select("p_partkey", flat(T.tokens(F.col("t"))).alias("tokens"), flat(T.numeric_tokens(F.col("t"))).alias("numbers"), flat(T.alpha_tokens(F.col("t"))).alias("alpha"))


@query(f"with {q_entities()} select entity_id, {q_phonetic('business_name')} as code from s2 union all select concat('p', p_partkey), {q_phonetic('p_name')} from part")
def phonetic_codes(spark, d):
    _, r = normalised(spark, d)
    p = table(spark, d, "part").select(F.expr("concat('p', p_partkey)").alias("entity_id"), F.col("p_name").alias("business_name_norm"))
    return r.select("entity_id", "business_name_norm").unionByName(p).select("entity_id", T.phonetic(F.col("business_name_norm")).alias("code"))


@query("select o_orderkey, regexp_extract(concat('po box ', o_orderkey, ' suite ', o_custkey + 10000), '\\b\\d{5,6}\\b') as zip, regexp_extract(concat('po box ', o_orderkey, ' suite ', o_custkey + 10000), 'p\\s*o\\s*box\\s*\\d+') as box from orders")
def address_extracts(spark, d):
    a = F.expr("concat('po box ', o_orderkey, ' suite ', o_custkey + 10000)")
    return table(spark, d, "orders").select("o_orderkey", T.zip_code(a).alias("zip"), T.po_box(a).alias("box"))


@query(f"with {q_entities()} select entity_id, {q_strip('business_name')} as stripped, {q_expand('business_name')} as expanded, {q_sorted('business_name')} as sorted from s2")
def name_variants(spark, d):
    _, r = normalised(spark, d)
    n = F.col("business_name_norm")
    return r.select("entity_id", T.strip_suffix(n).alias("stripped"), T.expand_abbreviations(n).alias("expanded"), T.sorted_tokens(n).alias("sorted"))


_PARTS = "select a.t as a, b.t as b from (select distinct concat(p_name, ' ', p_type) as t from part) a, (select distinct lower(concat(p_type, ' ', p_name)) as t from part) b"


@query(f"""select a, b, round({q_jaccard(q_tokens('a'), q_tokens('b'))}, 6) as jaccard, round({q_edit('a', 'b')}, 6) as edit, round({q_ratio('a', 'b')}, 6) as length_ratio, round({q_contains(q_tokens('a'), q_tokens('b'))}, 6) as containment, round({q_jaccard(q_chars('a'), q_chars('b'))}, 6) as char_jaccard from ({_PARTS})""")
def similarities(spark, d):
    """All pairs of the distinct names and types: a product of two small dimensions."""
    p = table(spark, d, "part")
    l, r = p.select(F.expr("concat(p_name, ' ', p_type)").alias("a")).distinct(), p.select(F.expr("lower(concat(p_type, ' ', p_name))").alias("b")).distinct()
    a, b = F.col("a"), F.col("b")
    return l.crossJoin(r).select("a", "b", F.round(S.token_jaccard(a, b), 6).alias("jaccard"), F.round(S.edit_similarity(a, b, S.EDIT_CHARS), 6).alias("edit"), F.round(S.length_ratio(a, b), 6).alias("length_ratio"), F.round(S.containment(a, b), 6).alias("containment"), F.round(S.char_jaccard(a, b), 6).alias("char_jaccard"))


@query()
def substring_ratios(spark, d):
    """Longest common substring: no built-in, held against a plain version in tests."""
    l, r = entities(spark, d)
    t = truth(spark, d).join(l.select(F.col("entity_id").alias("source1_entity_id"), F.col("business_name").alias("a")), "source1_entity_id").join(r.select(F.col("entity_id").alias("source2_entity_id"), F.col("business_name").alias("b")), "source2_entity_id")
    return t.select("source1_entity_id", "source2_entity_id", F.round(S.substring_ratio(F.lower("a"), F.lower("b")), 6).alias("lcs_ratio"))


# --- Blocking, features, matching --------------------------------------------------------------------------------------


def _block_query(key, q_key, cap):
    def run(spark, d):
        l, r = normalised(spark, d)
        return blocking.key_join(l, r, key(), cap)

    return run, f"with {q_entities()}, {q_block(q_key, cap, 'x')} select * from p_x"


for _name, _key, _q, _cap in (
    ("block_first_word", blocking.first_word_key, q_first("business_name"), 50), ("block_numeric_address", blocking.numeric_key, Q_NUMERIC_KEY, 50),
    ("block_two_word", blocking.two_word_key, Q_TWO_KEY, 50), ("block_small_cap", blocking.first_word_key, q_first("business_name"), 10),
):
    _run, _sql = _block_query(_key, _q, _cap)
    _run.__name__ = _name
    query(_sql)(_run)

_GRAMS = "select id, unnest(flatten(list_transform(list_filter(string_split(lower(name), ' '), lambda w: w <> ''), lambda w: list_transform(range(1, greatest(length(w), 1) + 1), lambda i: substr(concat(' ', w, ' '), i, 3))))) as gram from names"


def q_postings(names: str) -> str:
    return f"names as ({names}), g as ({_GRAMS}), tf as (select id, gram, count(*) as tf from g group by 1, 2), df as (select gram, count(*) as df from tf group by 1), raw as (select id, gram, tf * (ln((1.0 + (select count(*) from names)) / (1.0 + df)) + 1.0) as w from tf join df using (gram)), w as (select id, gram, w / sqrt(sum(w * w) over (partition by id)) as w from raw)"


@query("with " + q_postings("select concat('l', s_suppkey) as id, lower(replace(concat(s_name, ' ', n_name), '#', ' ')) as name from supplier join nation on s_nationkey = n_nationkey union all select concat('r', c_custkey), lower(replace(concat(c_name, ' ', n_name), '#', ' ')) from customer join nation on c_nationkey = n_nationkey")
       + ", s as (select a.id as a, b.id as b, round(sum(a.w * b.w), 9) as cosine from w a join w b using (gram) where a.id like 'l%' and b.id like 'r%' group by 1, 2 having sum(a.w * b.w) > 0.2) select substr(a, 2) as a, substr(b, 2) as b, round(cosine, 6) as cosine from s qualify row_number() over (partition by a order by cosine desc, substr(b, 2)) <= 5")
def block_trigram_topk(spark, d):
    n = table(spark, d, "nation")
    l = table(spark, d, "supplier").join(n, F.expr("s_nationkey = n_nationkey")).select(F.col("s_suppkey").alias("id"), F.expr("lower(replace(concat(s_name, ' ', n_name), '#', ' '))").alias("name"))
    r = table(spark, d, "customer").join(n, F.expr("c_nationkey = n_nationkey")).select(F.col("c_custkey").alias("id"), F.expr("lower(replace(concat(c_name, ' ', n_name), '#', ' '))").alias("name"))
    return tfidf.top_k(l, r, 5, 0.2).withColumn("cosine", F.round("cosine", 6))


@query(CAND + " select source1_entity_id, source2_entity_id from cand")
def candidates_union(spark, d):
    l, r = normalised(spark, d)
    return blocking.candidates(l, [r], "v3", names=False)


@query("with " + q_candidates(None, "v1") + " select source1_entity_id, source2_entity_id from cand")
def candidates_union_v1(spark, d):
    l, r = normalised(spark, d, "v1")
    return blocking.candidates(l, [r], "v1", names=False)


@query(CAND + ", gt as (select concat('c', o_custkey) as source1_entity_id, concat('o', o_orderkey) as source2_entity_id from orders) select (select count(*) from gt) as gt_pairs, count(*) as found, count(*)::double / (select count(*) from gt) as recall from gt join cand using (source1_entity_id, source2_entity_id)")
def blocking_recall(spark, d):
    return blocking.recall(candidates_union(spark, d), truth(spark, d))


def q_all_candidates(cap: int | None, profile: str, k: int) -> str:
    """The key passes and the pass of similar names."""
    key_passes, union = q_candidates(cap, profile).rsplit(", cand as ", 1)
    names = "select concat('l', entity_id) as id, business_name as name from s1 where length(business_name) >= 2 union all select concat('r', entity_id), business_name from s2 where length(business_name) >= 2"
    near = "select a.id as a, b.id as b, round(sum(a.w * b.w), 9) as cosine from w a join w b using (gram) where a.id like 'l%' and b.id like 'r%' group by 1, 2 having sum(a.w * b.w) > 0.2"
    found = f"select substr(a, 2) as source1_entity_id, substr(b, 2) as source2_entity_id from near qualify row_number() over (partition by a order by cosine desc, substr(b, 2)) <= {k}"
    return f"{key_passes}, {q_postings(names)}, near as ({near}), p_names as ({found}), cand as ({union[1:-1]} union select * from p_names)"


@query("with " + q_all_candidates(50, "v3", 5) + " select source1_entity_id, source2_entity_id from cand")
def candidates_all_passes(spark, d):
    """With the pass of similar names, which the queries on q_candidates leave out as their SQL does."""
    l, r, _ = written_sides(spark, d)
    return blocking.candidates(l, [r], "v3")


@query("with " + q_all_candidates(None, "v1", 10) + " select source1_entity_id, source2_entity_id from cand")
def candidates_all_passes_v1(spark, d):
    l, r, _ = written_sides(spark, d, "v1")
    return blocking.candidates(l, [r], "v1")


_TFIDF_PAIR = "select source1_entity_id, source2_entity_id, coalesce(sum(x.w * y.w), 0) as c from cand left join w x on x.id = concat('1', source1_entity_id) left join w y on y.id = concat('2', source2_entity_id) and x.gram = y.gram group by 1, 2"
_CORPUS = "select concat('1', entity_id) as id, business_name as name from s1 where entity_id in (select source1_entity_id from cand) union all select concat('2', entity_id), business_name from s2 where entity_id in (select source2_entity_id from cand)"


@query(CAND + ", " + q_postings(_CORPUS) + f" select source1_entity_id, source2_entity_id, round(round(c, 9), 6) as name_tfidf_cosine from ({_TFIDF_PAIR})")
def pair_tfidf_cosine(spark, d):
    l, r = normalised(spark, d)
    return pairs.name_cosine(blocking.candidates(l, [r], "v3", names=False), l, r).withColumn("name_tfidf_cosine", F.round("name_tfidf_cosine", 6))


_F1 = {
    "name_exact": q_equal("n1", "n2"), "name_jaccard": q_jaccard("nt1", "nt2"), "name_edit_sim": q_edit("n1", "n2"), "name_len_ratio": q_ratio("n1", "n2"), "name_len1": "length(n1)::double", "name_len2": "length(n2)::double",
    "name_first_word_match": q_equal("split_part(n1, ' ', 1)", "split_part(n2, ' ', 1)"), "name_alpha_jaccard": q_jaccard("al1", "al2"), "addr_exact": q_equal("a1", "a2"), "addr_jaccard": q_jaccard("at1", "at2"), "addr_edit_sim": q_edit("a1", "a2"),
    "addr_len_ratio": q_ratio("a1", "a2"), "addr_numeric_jaccard": q_jaccard("nu1", "nu2"), "addr_numeric_overlap": "len(list_intersect(nu1, nu2))::double", "country_match": q_equal("c1", "c2"), "country_both_empty": "(c1 = '' and c2 = '')::int::double",
    "name_addr_concat_jaccard": q_jaccard("x1", "x2"),
}
_F3 = {
    "name_sorted_edit_sim": q_edit("so1", "so2"), "name_stripped_edit_sim": q_edit("st1", "st2"), "name_stripped_jaccard": q_jaccard("stt1", "stt2"), "name_expanded_edit_sim": q_edit("ex1", "ex2"), "name_containment_1in2": q_contains("nt1", "nt2"), "name_containment_2in1": q_contains("nt2", "nt1"),
    "name_char_jaccard": q_jaccard("nc1", "nc2"), "name_word_count_diff": f"abs(len({q_words('n1')}) - len({q_words('n2')}))::double", "name_soundex_match": q_equal("sx1", "sx2"), "addr_zip_match": q_equal("regexp_extract(a1, '\\b\\d{5,6}\\b')", "regexp_extract(a2, '\\b\\d{5,6}\\b')"),
    "addr_pobox_match": q_equal("regexp_extract(a1, 'p\\s*o\\s*box\\s*\\d+')", "regexp_extract(a2, 'p\\s*o\\s*box\\s*\\d+')"), "addr_containment_1in2": q_contains("at1", "at2"), "addr_char_jaccard": q_jaccard("ac1", "ac2"),
}


def _q_entity(side: int, full: bool) -> str:
    n, a = "business_name", "business_address"
    cols = {"n": n, "a": a, "c": "country", "nt": q_tokens(n), "at": q_tokens(a), "al": q_alpha(n), "nu": q_numeric(a), "x": q_tokens(f"concat({n}, ' ', {a})")}
    if full:
        cols |= {"so": q_sorted(n), "st": q_strip(n), "stt": q_tokens(q_strip(n)), "ex": q_expand(n), "nc": q_chars(n), "ac": q_chars(a), "sx": q_phonetic(n)}
    return f"e{side} as (select entity_id as source{side}_entity_id, " + ", ".join(f"{e} as {k}{side}" for k, e in cols.items()) + f" from s{side})"


def q_features(which: dict[str, str], profile: str) -> str:
    cap = 50 if profile == "v3" else None
    rounded = ", ".join(f"round({e}, 6) as {k}" for k, e in which.items())
    return f"with {q_candidates(cap, profile)}, {_q_entity(1, profile == 'v3')}, {_q_entity(2, profile == 'v3')} select source1_entity_id, source2_entity_id, {rounded} from cand join e1 using (source1_entity_id) join e2 using (source2_entity_id)"


def _rounded(df):
    ids = ("source1_entity_id", "source2_entity_id")
    return df.select(*ids, *(F.round(c, 6).alias(c) for c in df.columns if c not in ids))


@query(q_features(_F1, "v1"))
def pair_features_v1(spark, d):
    l, r = normalised(spark, d, "v1")
    return _rounded(pairs.features(blocking.candidates(l, [r], "v1", names=False), l, r, "v1", cosine=False, edit_chars=S.EDIT_CHARS))


@query(q_features(_F1 | _F3, "v3"))
def pair_features_v3(spark, d):
    """All v3 features that SQL can restate; pair_features_v3_full has the others, too."""
    l, r = normalised(spark, d)
    return _rounded(pairs.features(blocking.candidates(l, [r], "v3", names=False), l, r, "v3", substring=False, cosine=False, edit_chars=S.EDIT_CHARS))


@query()
def pair_features_v3_full(spark, d):
    l, r, where = written_sides(spark, d)
    return _rounded(pairs.features_by_text(written(blocking.candidates(l, [r], "v3"), where, "candidates"), l, r, "v3"))


@query(CAND + " select source1_entity_id, source2_entity_id, (o_orderkey is not null)::int as label from cand left join orders on concat('c', o_custkey) = source1_entity_id and concat('o', o_orderkey) = source2_entity_id")
def assign_labels(spark, d):
    lists = truth(spark, d).groupBy("source1_entity_id").agg(F.array_join(F.collect_list("source2_entity_id"), " , ").alias("matched_entity_ids"))
    return submission.assign_labels(candidates_union(spark, d), lists)


@query(CAND + ", l as (select (o_orderkey is not null)::int as label from cand left join orders on concat('c', o_custkey) = source1_entity_id and concat('o', o_orderkey) = source2_entity_id) select sum(label)::bigint as positives, sum(1 - label)::bigint as negatives, round(100 * avg(label), 4) as positive_pct from l")
def label_balance(spark, d):
    return submission.label_balance(assign_labels(spark, d))


_SCORED = f"{CAND}, {_q_entity(1, False)}, {_q_entity(2, False)}, sc as (select source1_entity_id, source2_entity_id, (o_orderkey is not null)::int as label, round({q_jaccard('nt1', 'nt2')} * 0.5 + {q_jaccard('at1', 'at2')} * 0.5, 6) as proba from cand join e1 using (source1_entity_id) join e2 using (source2_entity_id) left join orders on concat('c', o_custkey) = source1_entity_id and concat('o', o_orderkey) = source2_entity_id and o_orderkey % 13 <> 0)"


def scored(spark, d):
    l, r = normalised(spark, d)
    f = pairs.features(blocking.candidates(l, [r], "v3", names=False), l, r, "v1", cosine=False)
    gt = truth(spark, d).where("cast(substring(source2_entity_id, 2) as long) % 13 <> 0")  # some matches are unknown, so that scores err
    return submission.assign_labels(f, gt).select("source1_entity_id", "source2_entity_id", "label", F.round(F.col("name_jaccard") * 0.5 + F.col("addr_jaccard") * 0.5, 6).alias("proba"))


_F05 = "case when tp + fp + fn = 0 then 1.0 when tp = 0 then 0.0 else 1.25 * (tp / (tp + fp)) * (tp / (tp + fn)) / (0.25 * (tp / (tp + fp)) + tp / (tp + fn)) end"


@query(_SCORED + f", g as (select source1_entity_id, sum((label = 1 and proba >= 0.5)::int)::double as tp, sum((label = 0 and proba >= 0.5)::int)::double as fp, sum((label = 1 and proba < 0.5)::int)::double as fn from sc group by 1) select round(avg({_F05}), 9) as macro_f05 from g")
def macro_f05(spark, d):
    df = scored(spark, d).withColumn("h", (F.col("proba") >= 0.5).cast("int"))
    return metrics.macro_f05(df, "label", "h", "source1_entity_id").select(F.round("macro_f05", 9).alias("macro_f05"))


@query(_SCORED + f", t as (select i, 0.01 + i * (0.98 / 199) as thr from range(200) r(i)), g as (select i, thr, source1_entity_id, sum((label = 1 and proba >= thr)::int)::double as tp, sum((label = 0 and proba >= thr)::int)::double as fp, sum((label = 1 and proba < thr)::int)::double as fn from sc, t group by 1, 2, 3) select round(thr, 4) as threshold, round(avg({_F05}), 7) as macro_f05 from g group by i, thr")
def tune_threshold(spark, d):
    return metrics.tune_threshold_f05(scored(spark, d), "label", "proba", "source1_entity_id").withColumn("macro_f05", F.round("macro_f05", 7))


@query(_SCORED + ", g as (select source1_entity_id, max(label) as y, max((proba >= 0.6)::int) as h, sum((label = 0 and proba >= 0.6)::int) as fp from sc group by 1) select sum((y = 1 and h = 0)::int)::bigint as singleton_errors, sum(fp)::bigint as false_merges from g")
def error_analysis(spark, d):
    df = scored(spark, d).withColumn("h", (F.col("proba") >= 0.6).cast("int"))
    return metrics.error_analysis(df, "label", "h", "source1_entity_id")


@query(_SCORED + ", m as (select source1_entity_id, string_agg(source2_entity_id, ',' order by source2_entity_id) as ids from sc where proba >= 0.5 group by 1) select entity_id as source1_entity_id, coalesce(ids, '') as matched_entity_ids from s1 left join m on entity_id = source1_entity_id")
def matching_results(spark, d):
    l, _ = entities(spark, d)
    return submission.matching_results(scored(spark, d), l, 0.5)


_BAD = "select concat('c', c_custkey) as source1_entity_id, case c_custkey % 4 when 0 then concat('o', c_custkey, ',o', c_custkey) when 1 then concat('zz', c_custkey) when 2 then '' else concat('o', c_custkey) end as matched_entity_ids from customer where c_custkey % 10 <> 9 union all select 'c1', '' union all select 'nobody', ''"


@query(f"""with r as ({_BAD}), x as (select source1_entity_id, trim(unnest(string_split(matched_entity_ids, ','))) as e from r), i as (select source1_entity_id, e, count(*) as c from x where e <> '' group by 1, 2), known as (select concat('o', o_orderkey) as e from orders)
select 'error' as level, 'missing_id' as "check", concat('c', c_custkey) as source1_entity_id, null::varchar as entity_id from customer where concat('c', c_custkey) not in (select source1_entity_id from r)
union all select 'error', 'unexpected_id', source1_entity_id, null from (select distinct source1_entity_id from r) where source1_entity_id not in (select concat('c', c_custkey) from customer)
union all select 'error', 'duplicate_id', source1_entity_id, null from r group by source1_entity_id having count(*) > 1
union all select 'error', 'duplicate_match', source1_entity_id, e from i where c > 1
union all select 'error', 'unknown_match', source1_entity_id, e from i where e not in (select e from known)
union all select 'error', 'match_not_candidate', source1_entity_id, i.e from i where not exists (select 1 from orders where concat('c', o_custkey) = source1_entity_id and concat('o', o_orderkey) = i.e)""")
def submission_violations(spark, d):
    table(spark, d, "customer").createOrReplaceTempView("customer")
    l, r = entities(spark, d)
    return submission.violations(spark.sql(_BAD), l, r, truth(spark, d))


@query(CAND + """, o1 as (select concat('c', c_custkey) as id, """ + ", ".join(f"{q_norm1(LEFT[c])} as {c}" for c in ("business_name", "business_address", "country")) + """ from customer join nation on c_nationkey = n_nationkey), o2 as (select concat('o', o_orderkey) as id, """ + ", ".join(f"{q_norm1(RIGHT[c])} as {c}" for c in ("business_name", "business_address", "country")) + """ from orders join (customer join nation on c_nationkey = n_nationkey) on o_custkey = c_custkey)
select source1_entity_id, source2_entity_id, concat('Do these two records describe the same business?', chr(10), 'A: name: ', coalesce(o1.business_name, ''), ', address: ', coalesce(o1.business_address, ''), ', country: ', coalesce(o1.country, ''), chr(10), 'B: name: ', coalesce(o2.business_name, ''), ', address: ', coalesce(o2.business_address, ''), ', country: ', coalesce(o2.country, ''), chr(10), 'Answer Yes or No: ') as prompt
from cand join o1 on o1.id = source1_entity_id join o2 on o2.id = source2_entity_id""")
def llm_prompts(spark, d):
    l, r = entities(spark, d)
    return er.prompts(candidates_union(spark, d), l, r)


@query()
def truth_aware_sample(spark, d):
    """A sampling operator: left entities by hash, their matches, and other records."""
    from millrace.sources.synthetic import truth_aware_sample as sample

    l, r = entities(spark, d)
    left, right, _ = sample(l, r, truth(spark, d), 100)
    return left.select("entity_id", "split").unionByName(right.select("entity_id", F.lit("right").alias("split")))


@query()
def er_end_to_end(spark, d):
    """Candidates of all passes, v3 features, the rule score and matching results: the flagship plan."""
    l, r, where = written_sides(spark, d)
    found = written(blocking.candidates(l, [r], "v3"), where, "candidates")
    return submission.matching_results(er.rule_score(pairs.features_by_text(found, l, r, "v3", substring=False, cosine=False)), l, 0.6)


# --- Metrics and ensembles ----------------------------------------------------------------------------------------------

_RULE = "(n_chars % 7 > 0)::int"


def _judged(spark, d):
    return table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id").select("doc_id", "quality", F.expr("cast(n_chars % 7 > 0 as int)").alias("pred"), F.expr("round((n_chars % 97) / 97.0D, 6)").alias("proba"))


_JUDGED = f"j as (select doc_id, quality, {_RULE} as pred, round((n_chars % 97) / 97.0::double, 6) as proba from labels join documents using (doc_id))"


@query(f"with {_JUDGED}, l as (select unnest([0, 1]) as y_true), k as (select unnest([0, 1])::int as y_pred) select l.y_true, k.y_pred, count(j.doc_id) as n from l cross join k left join j on quality = y_true and pred = y_pred group by 1, 2")
def confusion_matrix(spark, d):
    return metrics.confusion(_judged(spark, d), "quality", "pred")


_CLASS = f"""with {_JUDGED}, c as (select l, sum((quality = l)::int)::double as s, sum((pred = l)::int)::double as h, sum((quality = l and pred = l)::int)::double as tp from j, (select unnest([0, 1]) as l) group by 1),
p as (select l, s, tp, case when h > 0 then tp / h else 0 end as p, case when s > 0 then tp / s else 0 end as r from c), f as (select *, case when p + r > 0 then 2 * p * r / (p + r) else 0 end as f from p),
m as (select sum(tp) / sum(s) as accuracy, avg(f) as f1_macro, sum(tp) / sum(s) as f1_micro, sum(f * s) / sum(s) as f1_weighted, max(case when l = 1 then f end) as f1_binary, avg(p) as precision_macro, sum(tp) / sum(s) as precision_micro, avg(r) as recall_macro, sum(tp) / sum(s) as recall_micro from f)
select metric, round(value, 6) as value from (unpivot m on columns(*) into name metric value value)"""


@query(_CLASS)
def classification_metrics(spark, d):
    return metrics.classification(_judged(spark, d), "quality", "pred")


@query(f"with {_JUDGED}, t as (select i, 0.01 + i * (0.98 / 99) as thr from range(100) r(i)), s as (select i, thr, sum((quality = 1 and proba >= thr)::int)::double as tp, sum((quality <> 1 and proba >= thr)::int)::double as fp, sum((quality = 1 and proba < thr)::int)::double as fn from j, t group by 1, 2) select round(thr, 6) as threshold, round(2 * tp / (2 * tp + fp + fn), 6) as f1 from s order by f1 desc, thr limit 1")
def search_threshold_f1(spark, d):
    """The best threshold is the feature: one row."""
    return metrics.search_threshold(_judged(spark, d), "quality", "proba")


def _models(spark, d):
    j = _judged(spark, d)
    return [j.select("doc_id", F.col("proba").alias("prediction")), j.select("doc_id", F.expr("1 - proba").alias("prediction")), j.select("doc_id", F.expr("double(pred)").alias("prediction"))]


@query(f"with {_JUDGED} select doc_id, round((proba + (1 - proba) + pred) / 3, 6) as prediction from j")
def ensemble_mean(spark, d):
    return metrics.ensemble(_models(spark, d), "doc_id", "prediction").withColumn("prediction", F.round("prediction", 6))


@query(f"with {_JUDGED} select doc_id, round((2 * proba + (1 - proba) + pred) / 4, 9) as prediction from j")
def ensemble_weighted(spark, d):
    return metrics.ensemble(_models(spark, d), "doc_id", "prediction", [2, 1, 1]).withColumn("prediction", F.round("prediction", 9))


@query(f"""with {_JUDGED}, m as (select 'model_0' as model, (proba >= 0.5)::int as h, quality from j union all select 'model_1', (1 - proba >= 0.5)::int, quality from j union all select 'model_2', pred, quality from j union all select 'ensemble', (round((1 + pred) / 3, 9) >= 0.5)::int, quality from j),
a as (select model, round(avg((h = quality)::int), 6) as accuracy from m group by 1) select model, accuracy, model = 'ensemble' and accuracy > (select max(accuracy) from a where model <> 'ensemble') as improves from a""")
def ensemble_compare(spark, d):
    return metrics.compare_ensemble(_models(spark, d), table(spark, d, "labels"), "doc_id", "prediction", "quality")


@query("""with i as (select 0 as part, doc_id from labels union all select 1, doc_id from labels where quality = 1 union all select 2, doc_id from labels union all select 2, doc_id from labels where toxic = 1)
select part, count(*) as rows, count(*) - count(distinct doc_id) as duplicate_ids, (select count(distinct doc_id) from i) - count(distinct doc_id) as missing_ids from i group by 1""")
def id_alignment(spark, d):
    l = table(spark, d, "labels").select("doc_id", "quality", "toxic")
    return metrics.id_alignment([l, l.where("quality = 1"), l.unionByName(l.where("toxic = 1"))], "doc_id")


@query(f"with {_JUDGED} select count(*) as n, round(avg(proba), 6) as mean_proba from labels join j using (doc_id)")
def eval_join(spark, d):
    return table(spark, d, "labels").select("doc_id").join(_judged(spark, d), "doc_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("proba"), 6).alias("mean_proba"))


# --- Features and models ------------------------------------------------------------------------------------------------


@query("select c_custkey, coalesce(dense_rank() over (order by s nulls last) - 1, -1)::int * (s is not null)::int - (s is null)::int as seg_encoded from (select c_custkey, case when c_custkey % 17 = 0 then null else c_mktsegment end as s from customer)")
def category_codes(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.expr("case when c_custkey % 17 = 0 then null else c_mktsegment end").alias("seg"))
    return features.encode(c, "seg").select("c_custkey", "seg_encoded")


@query(f"""select p_partkey, p_size, p_retailprice, (dense_rank() over (order by p_brand) - 1)::int as p_brand_encoded, (dense_rank() over (order by p_type) - 1)::int as p_type_encoded, length(p_name)::int as p_name_char_len, len(regexp_extract_all(p_name, '\\S+'))::int as p_name_word_count,
regexp_matches(p_name, '\\d')::int as p_name_has_digits, regexp_matches(p_name, '[A-Z]')::int as p_name_has_upper, len({q_tokens('lower(p_name)')})::int as p_name_unique_words from part""")
def feature_build(spark, d):
    return features.build(table(spark, d, "part"), "p_partkey", None, ("p_name",))


@query("select c_custkey, c_acctbal, n, max_price as max_price, c_acctbal2 as c_acctbal_feat1 from customer left join (select o_custkey, count(*) as n, max(o_totalprice) as max_price from orders group by 1) on c_custkey = o_custkey left join (select o_custkey as k, min(o_totalprice) as c_acctbal2 from orders group by 1) on c_custkey = k")
def feature_merge(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    a = o.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("max_price"))
    b = o.select("c_custkey", F.col("o_totalprice").alias("c_acctbal"))
    b = setops.keep_one(b, ["c_custkey"], ["c_acctbal"])
    return features.merge(table(spark, d, "customer").select("c_custkey", "c_acctbal"), [a, b, table(spark, d, "region")], "c_custkey")


def _quality_frame(spark, d):
    f = T.text_features(table(spark, d, "documents"), "text").drop("text", "lang", "source")
    return f.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id")


@query()
def baseline_train_eval(spark, d):
    parts = sharding.split(_quality_frame(spark, d), "doc_id", "stratified", 0.2, "quality")
    m, _ = models.train_baseline(parts.where("split = 'train'").drop("split"), "doc_id", "quality", "logistic")
    return metrics.classification(m.predict(parts.where("split = 'val'")).withColumn("y", F.col("quality").cast("string")), "y", "prediction")


@query()
def batch_predict(spark, d):
    m, _ = models.train_baseline(_quality_frame(spark, d), "doc_id", "quality", "random_forest", trees=20)
    return models.batch_predict(m, T.text_features(table(spark, d, "documents"), "text"), "doc_id")


@query("select (select count(*) from documents) as rows, (select count(*) from documents) as expected_rows, 0::bigint as missing_ids, 0::bigint as duplicate_ids, sum((n_chars % 5 = 0)::int)::bigint as null_predictions from documents")
def prediction_checks(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.expr("case when n_chars % 5 = 0 then null else 1 end").alias("prediction"))
    return models.validate_predictions(docs, docs, "doc_id")


@query()
def screening(spark, d):
    parts = sharding.split(_quality_frame(spark, d), "doc_id", "random", 0.3)
    return models.screen(parts.where("split = 'train'").drop("split"), parts.where("split = 'val'").drop("split"), "doc_id", "quality")


# --- Providers, streaming -----------------------------------------------------------------------------------------------


@query("select doc_id, 0.0::float as text_emb_0, 0.0::float as text_emb_1, 0.0::float as text_emb_2, 0.0::float as text_emb_3 from documents")
def placeholder_embeddings(spark, d):
    return providers.expand_embedding(providers.text_embeddings(table(spark, d, "documents"), "doc_id", "text", 4), 4)


@query("select page_id, case when page_id % 5 = 0 then '' else html end as text, case when page_id % 5 = 0 then 'ValueError: unreadable' end as error from pages")
def provider_ocr(spark, d):
    """The OCR operator with a back end that decodes bytes and fails on every fifth page."""

    def backend(data: bytes) -> str:
        if data is None:
            raise ValueError("unreadable")
        return data.decode()

    return providers.ocr(table(spark, d, "pages").withColumn("content", F.expr("case when page_id % 5 = 0 then null else cast(html as binary) end")), "page_id", "content", backend)


@query("select date_trunc('hour', ts) as window_start, date_trunc('hour', ts) + interval 1 hour as window_end, event_type, count(*) as n from events group by 1, 2, 3")
def windowed_counts(spark, d):
    return resume.windowed_counts(table(spark, d, "events"), "ts", ["event_type"])


@query()
def ensemble_threshold(spark, d):
    """The best threshold of a blend."""
    return metrics.ensemble_with_threshold(_models(spark, d), table(spark, d, "labels"), "doc_id", "prediction", "quality")[1]


@query("select page_id, 0.0::float as img_emb_0, 0.0::float as img_emb_1 from pages")
def image_embeddings(spark, d):
    """Without a model, zeros."""
    found = providers.image_embeddings(table(spark, d, "pages").withColumn("content", F.col("html").cast("binary")), "page_id", dim=2)
    return providers.expand_embedding(found, 2, "img_emb_")
