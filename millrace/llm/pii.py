"""PII: regular expressions propose spans, checksums confirm them, context words adjust the score. Built-ins only.

Places come from the lengths of the gaps (split) and of the matches (regexp_extract_all) of one pattern, in code points, summed
in three levels, so that a text's cost grows with its length and not with the square of its matches.
Patterns are written so that the regular-expression engine neither recurses nor goes back over long runs:
possessive runs, one-character groups, and a start only where no earlier start could match.

Kinds: email, ip, card (Luhn), phone; and iban (mod 97), which the method adds. A span's context is up to CONTEXT characters before
and after it, as far as its neighbours of the same kind. Defined results: a null or empty text
has no spans; repeated doc_ids keep a row each, a missing one is null; an empty table gives no rows; find() ignores other columns, redact() keeps
them, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban")
BASE = KINDS[:4]
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])(?:[.A-Za-z0-9-](?<!\.(?![A-Za-z0-9-])))++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[0-9\x20-](?<![\x20-]{2})){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
}
#: A cheap test that a text with a match passes.
GATES = {"email": "instr(text, '@') > 0", "ip": "instr(text, '.') > 0", "card": "true", "phone": "instr(text, '+') > 0", "iban": "true"}
#: Score of a confirmed span without context, and words that raise it when within CONTEXT characters before or after.
WEIGHT = {"email": 0.9, "ip": 0.5, "card": 0.8, "phone": 0.6, "iban": 0.95}
WORDS = {
    "email": "mail|contact|write", "ip": "ip|host|server|login|address", "card": "card|visa|credit|payment|pay", "phone": "phone|tel|call|mobile|fax|sms", "iban": "iban|bank|account|konto|cuenta|compte",
}
CONTEXT = 40
#: Entries of a running sum or maximum that a step adds up at each of its three levels.
STEP = 32
#: Characters of a piece of a text from which spans are cut out.
PIECE = 1024
CONTEXT_GAIN = 0.15


def _valid(kind: str, v: str) -> str:
    """SQL: whether value v of a match is confirmed."""
    digits = f"regexp_replace({v}, '[^0-9]', '')"
    if kind == "ip":
        return f"forall(split({v}, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(substring(ltrim('0', p), 1, 4) as int), 0) <= 255)"
    if kind == "card":
        return f"(length({digits}) between 16 and 19 and luhn_check({digits}))"
    if kind == "phone":
        return f"length({digits}) between 8 and 15"
    if kind == "iban":
        # The first four characters go last, letters count as 10 to 35, and the number modulo 97 must be 1.
        packed = f"replace({v}, ' ', '')"
        moved = f"concat(substring({packed}, 5), substring({packed}, 1, 4))"
        return f"aggregate(split({moved}, ''), 0, (r, c) -> case when c = '' then r when c >= 'A' then (r * 100 + ascii(c) - 55) % 97 else (r * 10 + ascii(c) - 48) % 97 end) = 1"
    return "true"


def _escape(p: str) -> str:
    return p.replace("\\", "\\\\").replace("'", "\\'")


def _let(name: str, value: str, body: str) -> str:
    """SQL: body, in which name stands for value, evaluated once a row."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _levels(array: str, body: str, fold: str) -> str:
    """SQL: body, in which u1 and u2 are the folds of each STEP and each STEP * STEP entries of a non-empty array."""
    up = lambda x: f"transform(sequence(0, cast((size({x}) - 1) div {STEP} as int)), q -> {fold.format(f'slice({x}, q * {STEP} + 1, {STEP})')})"
    return _let("u1", up(array), _let("u2", up("u1"), body))


def _before(array: str, i: str, fold: str, join: str) -> str:
    """SQL, within _levels: the fold of the first i entries of array."""
    a, b = f"cast({i} div {STEP * STEP} as int)", f"cast({i} div {STEP} as int)"
    return join.format(fold.format(f"slice(u2, 1, {a})"), fold.format(f"slice(u1, {a} * {STEP} + 1, {b} - {a} * {STEP})"), fold.format(f"slice({array}, {b} * {STEP} + 1, {i} - {b} * {STEP})"))


_SUM, _ADD = "aggregate({}, 0, (a, x) -> a + x)", "({} + {} + {})"
_MOST, _GREATEST = "coalesce(array_max({}), 0)", "greatest({}, {}, {})"
_SPAN = "array<struct<kind:int,start:int,end:int,score:double>>"


def _spans(kind: str) -> str:
    """SQL: the confirmed spans of a kind in a text t."""
    p, n = _escape(PATTERNS[kind]), KINDS.index(kind)
    # A card's match may end in one separator, which is cut off.
    value = "rtrim(' -', m[i])" if kind == "card" else "m[i]"
    start = _before("l", "i", _SUM, _ADD) + " + length(g[i])"
    near = f"lower(concat(right(g[i], {CONTEXT}), ' ', substring(m[i], length(v) + 1), left(g[i + 1], {CONTEXT})))"
    score = f"cast(round(least(1.0D, {WEIGHT[kind]}D + case when regexp_like({near}, '\\\\b({WORDS[kind]})') then {CONTEXT_GAIN}D else 0.0D end), 3) as double)"
    made = f"named_struct('kind', {n}, 'start', s, 'end', s + length(v), 'score', {score})"
    one = _let("v", value, f"case when {_valid(kind, 'v')} then {_let('s', start, made)} end")
    found = _levels("l", f"filter(transform(sequence(0, size(m) - 1), i -> {one}), x -> x is not null)", _SUM)
    found = _let("g", f"split(t, '{p}', -1)", _let("l", "transform(m, (x, i) -> length(x) + length(g[i]))", found))
    gate = GATES[kind].replace("text", "t")
    return _let("m", f"case when {gate} then regexp_extract_all(t, '{p}', 0) else cast(array() as array<string>) end", f"case when size(m) = 0 then cast(array() as {_SPAN}) else cast({found} as {_SPAN}) end")


def spans(text: str) -> Column:
    """All confirmed spans of a text, null as empty: array of struct(kind number, start, end, score), by kind, then start."""
    return F.expr(_let("t", f"coalesce(cast({text} as string), '')", f"concat({', '.join(map(_spans, KINDS))})"))


def _joined(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, x -> concat_ws(':', element_at(array({names}), x.kind + 1), x.start, x.end)), ',')"


def find(docs: DataFrame) -> DataFrame:
    """Per document: counts by base kind, base_sha256, spans, n_iban, max_score, and scores: those of all spans, in their order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), spans("text").alias("pii"))
    count = lambda k: F.expr(f"cast(size(filter(pii, x -> x.kind = {k})) as bigint)")
    return rows.select(
        "doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(BASE)),
        F.sha2(F.expr(_joined(f"filter(pii, x -> x.kind < {len(BASE)})")), 256).alias("base_sha256"),
        F.expr(_joined("pii")).alias("spans"), count(4).alias("n_iban"), F.expr("array_max(transform(pii, x -> x.score))").alias("max_score"), F.expr("transform(pii, x -> x.score)").alias("scores"),
    )


def _replaced() -> str:
    """SQL: text t with the spans x, sorted by start, end and kind, replaced by their kinds; one that begins before an earlier one ends goes with it."""
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    cut = lambda a, z: f"substring(array_join(slice(c, cast({a} div {PIECE} as int) + 1, cast({z} div {PIECE} as int) - cast({a} div {PIECE} as int) + 1), ''), {a} % {PIECE} + 1, {z} - {a})"
    # at: where the text that is kept before a span begins; null for a span that goes with an earlier one.
    at = _before("e", "i", _MOST, _GREATEST)
    part = _let("at", at, f"case when x[i].start >= at then concat({cut('at', 'x[i].start')}, element_at(array({names}), x[i].kind + 1)) else '' end")
    parts = _levels("e", f"array_join(transform(sequence(0, size(x) - 1), i -> {part}), '')", _MOST)
    rest = _let("z", "array_max(e)", f"{cut('z', 'length(t)')}")
    return _let("e", "transform(x, y -> y.end)", _let("c", f"regexp_extract_all(t, '(?s).{{1,{PIECE}}}', 0)", f"concat({parts}, {rest})"))


def redact(docs: DataFrame, text: str = "text", least_score: float = 0.5) -> DataFrame:
    """docs with every span of at least least_score replaced by its kind in brackets; overlapping spans as the first of them."""
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{text}`").cast("string").alias("t"))
    row = row.withColumn("x", spans("t")).withColumn("x", F.expr(f"array_sort(transform(filter(x, y -> y.score >= {least_score}), y -> named_struct('start', y.start, 'end', y.end, 'kind', y.kind)))"))
    done = F.expr(f"case when size(x) = 0 then t else {_replaced()} end")
    return row.withColumn("t", done).select(*(F.col("t").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns))
