"""Secret scan: fixed patterns, and a battery of randomness tests for other tokens.

Only built-in expressions. The fixed patterns give the base spans. Every other long
token is tested: its encoding is inferred, and the chi-squared statistic of its
symbols is held against what text written in that alphabet would give. The runs test
and the serial correlation must not speak against randomness. The p-values of a
length class go through the Benjamini-Hochberg step-up procedure.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.tables import materialize

# Fixed patterns: kind, pattern, and the group and least length of its value. Runs of one
# class are as long as they can be, so that their least length can be in the pattern.
BASE = (
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
RANDOM = "random"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
DIGITS = "0123456789"
# What a token is made of.
TOKEN = UPPER + LOWER + DIGITS + "+/_=-"


@dataclass(frozen=True)
class Encoding:
    """An alphabet, how to tell it, and how far from uniform text in it is.

    Characters of a token that are not in the alphabet are left out of the tests.
    ``effect`` is the sum over symbols of (p - 1/k)^2 k for words of a natural language,
    whose letters have a sum of squared frequencies of about 0.065. The median cuts
    the alphabet into halves for the runs test.
    """

    name: str
    pattern: str
    alphabet: str
    effect: float


# In the order in which they are tried; the last takes the rest.
ENCODINGS = (
    Encoding("hex", "^(?=.*[0-9])[0-9a-f]+$", DIGITS + "abcdef", 1.0),
    Encoding("HEX", "^(?=.*[0-9])[0-9A-F]+$", DIGITS + "ABCDEF", 1.0),
    Encoding("base32", "^(?=.*[2-7])[A-Z2-7]+$", UPPER + "234567", 1.0),
    Encoding("lower", "^[a-z]+$", LOWER, 0.7),
    Encoding("upper", "^[A-Z]+$", UPPER, 0.7),
    Encoding("base36", "^[a-z0-9]+$", LOWER + DIGITS, 1.3),
    Encoding("BASE36", "^[A-Z0-9]+$", UPPER + DIGITS, 1.3),
    Encoding("base64url", "^(?=[^_-]*[_-])[^+/]+$", UPPER + LOWER + DIGITS + "-_", 3.2),
    Encoding("base64", ".*", UPPER + LOWER + DIGITS + "+/", 3.2),
)

# p-values are kept as quarter powers of two; this is the smallest, 2^-500. No table is
# so large that one hypothesis with it would not be a discovery.
SMALLEST = 2000


# --- places of matches -------------------------------------------------------


def _running(lengths: Column) -> Column:
    start = F.struct(
        F.lit(0).cast("long").alias("sum"), F.array().cast("array<long>").alias("all")
    )

    def add(state: Column, x: Column) -> Column:
        total = state["sum"] + x
        return F.struct(
            total.alias("sum"), F.concat(state["all"], F.array(total)).alias("all")
        )

    return F.aggregate(lengths, start, add, lambda state: state["all"])


def running_totals(lengths: Column, block: int = 256) -> Column:
    """Totals up to each element, in blocks, as appending to long arrays is slow."""
    steps = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / block).cast("int"))
    blocks = F.transform(
        steps, lambda b: _running(F.slice(lengths, b * block + 1, block))
    )
    bases = _running(F.transform(blocks, lambda b: F.element_at(b, -1)))
    shifted = F.zip_with(
        blocks,
        F.concat(F.array(F.lit(0).cast("long")), bases),
        lambda totals, base: F.when(
            totals.isNotNull(), F.transform(totals, lambda x: x + base)
        ),
    )
    return F.flatten(F.filter(shifted, lambda s: s.isNotNull()))


def located(df: DataFrame, text: str, pattern: str, name: str) -> DataFrame:
    """Add ``name``: the matches as structs (start, end, token), in code points.

    A match's place follows from the lengths of the matches and of what is between
    them. The text is split only if there is a match.
    """
    hits, ends = f"{name}_hits", f"{name}_ends"
    df = df.withColumn(hits, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    gaps = F.slice(F.split(F.col(text), pattern, -1), F.lit(1), F.size(hits))
    steps = F.zip_with(
        gaps, hits, lambda g, h: (F.char_length(g) + F.char_length(h)).cast("long")
    )
    df = df.withColumn(ends, F.when(F.size(hits) > 0, steps))
    df = df.withColumn(ends, F.when(F.size(hits) > 0, running_totals(F.col(ends))))
    spans = F.zip_with(
        hits,
        ends,
        lambda h, e: F.struct(
            (e - F.char_length(h)).alias("start"), e.alias("end"), h.alias("token")
        ),
    )
    empty = F.array().cast("array<struct<start:bigint,end:bigint,token:string>>")
    return df.withColumn(name, F.coalesce(spans, empty)).drop(hits, ends)


# --- the tests ---------------------------------------------------------------


def normal_below(z: Column) -> Column:
    """The standard normal distribution function, to about 1e-7.

    Below -5 the error is less than 1e-4 of the value itself.
    """
    x = F.abs(z) / 2**0.5
    t = 1 / (1 + 0.3275911 * x)
    series = t * (
        0.254829592
        + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))
    )
    tail = series * F.exp(-x * x) / 2
    a = F.abs(z)
    ratio = a + 1 / (a + 2 / (a + 3 / (a + 4 / (a + 5 / a))))
    far = F.exp(-x * x) / (2 * math.pi) ** 0.5 / ratio
    return F.when(z < -5, far).when(z < 0, tail).otherwise(1 - tail)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _count(token: Column, part: Column | str) -> Column:
    part = F.lit(part) if isinstance(part, str) else part
    return F.char_length(token) - F.char_length(F.replace(token, part, F.lit("")))


def noncentral_below(x: Column, df: Column, shift: Column) -> Column:
    """The noncentral chi-squared distribution function, as Sankaran approximates it.

    A power of the variable is taken for normal. In the lower tail this is off by up to a
    third where the value is 1e-8; a normal variable itself would be off by many powers.
    """
    a, b, c = df + shift, df + 2 * shift, df + 3 * shift

    def below(s: Column) -> Column:
        h, p = s["h"], s["p"]
        m = (h - 1) * (1 - 3 * h)
        mean = 1 + h * p * (h - 1 - (2 - h) * m * p / 2)
        spread = h * F.sqrt(2 * p) * (1 + m * p / 2)
        return _let((F.pow(s["x"], h) - mean) / spread, normal_below)

    h = 1 - 2 * a * c / (3 * b * b)
    terms = [(F.greatest(x, F.lit(0.0)) / a).alias("x"), h.alias("h"), (b / (a * a)).alias("p")]
    return _let(F.struct(*terms), below)


def chi_squared(symbols: Column, alphabet: Column) -> Column:
    """Of the symbol counts against a uniform alphabet."""
    places = F.sequence(F.lit(1), F.char_length(alphabet))
    squares = F.transform(
        places,
        lambda i: F.pow(
            _count(symbols, F.substring(alphabet, i, F.lit(1))).cast("double"), F.lit(2.0)
        ),
    )
    n = F.char_length(symbols)
    return _total(squares) * F.char_length(alphabet) / n - n


def runs_z(symbols: Column, alphabet: Column, halves: Column) -> Column:
    """Runs above and below the alphabet's median; null if there is one side only."""
    sides = F.call_function("translate", symbols, alphabet, halves)

    def z(s: Column) -> Column:
        a, b = _count(s, "0").cast("double"), _count(s, "1").cast("double")
        n = a + b
        runs = 1 + _count(s, "01") / 2 + _count(s, "10") / 2
        mean = 1 + 2 * a * b / n
        variance = (mean - 1) * (mean - 2) / (n - 1)
        return F.when(variance > 0, (runs - mean) / F.sqrt(variance))

    return _let(sides, z)


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)


def serial_z(symbols: Column, alphabet: Column) -> Column:
    """Lag-one correlation of the symbols' places in the alphabet, times root n - 1."""
    letters = F.filter(F.split(symbols, ""), lambda c: c != "")
    values = F.transform(letters, lambda c: F.instr(alphabet, c).cast("double"))

    def centred(xs: Column) -> Column:
        # Computed once: inside the function of the elements it would be for each.
        return _let(_total(xs) / F.size(xs), lambda mean: F.transform(xs, lambda x: x - mean))

    def z(xs: Column) -> Column:
        n = F.size(xs)
        spread = _total(F.transform(xs, lambda x: x * x))
        head, tail = F.slice(xs, F.lit(1), n - 1), F.slice(xs, F.lit(2), n - 1)
        lagged = F.zip_with(head, tail, lambda x, y: x * y)
        return F.when(spread > 0, _total(lagged) / spread * F.sqrt(n - 1.0))

    return _let(_let(values, centred), z)


def _inferred(token: Column) -> Column:
    """Of the token's encoding: symbols (the token's own), alphabet, halves, effect."""

    def of(e: Encoding) -> Column:
        half = len(e.alphabet) // 2
        foreign = "".join(c for c in TOKEN if c not in e.alphabet)
        return F.struct(
            F.translate(token, foreign, "").alias("symbols"),
            F.lit(e.alphabet).alias("alphabet"),
            F.lit("0" * half + "1" * (len(e.alphabet) - half)).alias("halves"),
            F.lit(e.effect).alias("effect"),
        )

    *first, last = ENCODINGS
    found = F.when(F.lit(False), of(last))
    for e in first:
        found = found.when(token.rlike(e.pattern), of(e))
    return found.otherwise(of(last))


def p_value(token: Column, veto: float = 3.3) -> Column:
    """Small if text in the token's alphabet would hardly be so close to uniform.

    The null hypothesis is a source as uneven as words are: noncentral chi-squared,
    with a noncentrality that grows with the length, so that short tokens never reach
    small values. It is 1 if runs or serial correlation are ``veto`` standard
    deviations off, or cannot be computed. The work is linear in the token's length.
    """

    def p(s: Column) -> Column:
        symbols, alphabet = s["symbols"], s["alphabet"]
        n = F.char_length(symbols)
        runs = F.abs(runs_z(symbols, alphabet, s["halves"]))
        serial = F.abs(serial_z(symbols, alphabet))
        near = noncentral_below(
            chi_squared(symbols, alphabet),
            F.char_length(alphabet) - F.lit(1.0),
            n * s["effect"],
        )
        plain = (n >= 2) & (runs < veto) & (serial < veto)
        return F.when(plain, near).otherwise(F.lit(1.0))

    bare = F.rtrim(token, F.lit("="))
    return _let(_let(bare, _inferred), p)


def step_up(counts: dict[int, int], rate: float) -> int:
    """Benjamini-Hochberg on a grid: the least grid number that is a discovery.

    ``counts`` has the number of hypotheses by grid number b, meaning p <= 2^(-b/4).
    Without a discovery it is a number above all of them.
    """
    total, passed = sum(counts.values()), 0
    top = max([80, *counts])
    found = top + 1
    for b in range(top, -1, -1):
        passed += counts.get(b, 0)
        if passed and 2 ** (-b / 4) <= rate * passed / total:
            found = b
    return found


# --- the operator ------------------------------------------------------------


def _long_value(pattern: str, group: int, least: int):
    def test(s: Column) -> Column:
        return F.char_length(F.regexp_extract(s["token"], pattern, group)) >= least

    return test


def _ranked(rank: int, kind: str):
    def span(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"),
            F.lit(rank).alias("rank"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
        )

    return span


def _inside(spans: list[str], c: Column) -> Column:
    covered = F.lit(False)
    for kind in spans:
        covered = covered | F.exists(
            kind, lambda s: (s["start"] <= c["start"]) & (c["end"] <= s["end"])
        )
    return covered


def find_secrets(
    docs: DataFrame,
    text_column: str = "text",
    keep_text: bool = True,
    min_token: int = 20,
    rate: float = 0.01,
) -> DataFrame:
    """Each row of ``docs`` with its secrets.

    Columns: row (a struct c0, c1, ... of the columns other than the text, in their
    order), text (null unless ``keep_text``), secrets: structs (start, rank, end, kind)
    in code points, end exclusive, sorted. Kinds are those of ``BASE`` and "random",
    ranked in that order. A null text has none. Rows with equal ids are separate; each
    occurrence of a repeated token is a hypothesis of its own.

    Tested are runs of ``min_token`` or more characters of the base64 alphabets outside
    base spans. ``rate`` is the expected share of false discoveries among those made
    in a length class (from one power of two to the next).
    """
    others = [c for c in docs.columns if c != text_column]
    df = docs.select(
        F.struct(
            *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)],
            F.lit(0).alias("end"),
        ).alias("row"),
        F.col(f"`{text_column}`").cast("string").alias("kept"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
    )
    for kind, pattern, group, least in BASE:
        df = located(df, "text", pattern, kind)
        if group:
            df = df.withColumn(kind, F.filter(kind, _long_value(pattern, group, least)))
    kinds = [kind for kind, *_ in BASE]
    df = located(df, "text", f"[A-Za-z0-9+/_=-]{{{min_token},}}", "tokens")
    tested = F.transform(
        F.filter("tokens", lambda c: ~_inside(kinds, c)),
        lambda c: F.struct(
            c["start"].alias("start"),
            c["end"].alias("end"),
            F.floor(F.log2((c["end"] - c["start"]).cast("double")))
            .cast("int")
            .alias("size"),
            _grid(p_value(c["token"])).alias("grid"),
        ),
    )
    base = [
        F.transform(kind, _ranked(rank, kind))
        for rank, kind in enumerate(kinds)
    ]
    df = materialize(
        df.select(
            "row",
            F.col("kept" if keep_text else "row.end").cast("string").alias("text"),
            F.concat(*base).alias("base"),
            tested.alias("tested"),
        )
    )
    grids = df.select(F.explode("tested").alias("t")).groupBy("t.size", "t.grid").count()
    # A row per length class and grid number: at most 32 times 2,001.
    by_size: dict[int, dict[int, int]] = {}
    for size, grid, count in grids.collect():
        by_size.setdefault(size, {})[grid] = count
    least = F.array(*[_cut(by_size, size, rate) for size in range(32)])
    found = F.transform(
        F.filter("tested", lambda c: c["grid"] >= F.get(least, c["size"])),
        _ranked(len(kinds), RANDOM),
    )
    return df.select("row", "text", F.array_sort(F.concat("base", found)).alias("secrets"))


def _cut(by_size: dict[int, dict[int, int]], size: int, rate: float) -> Column:
    return F.lit(step_up(by_size[size], rate) if size in by_size else SMALLEST + 1)


def _grid(p: Column) -> Column:
    steps = F.floor(-4 * F.log2(F.greatest(p, F.lit(2.0 ** -(SMALLEST / 4)))))
    return F.least(steps, F.lit(SMALLEST)).cast("int")


def joined(secrets: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    return F.array_join(
        F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])),
        ",",
    )


def disjoint(spans: Column) -> Column:
    """Sorted spans, with those that overlap or touch made one."""

    def one(start: Column, end: Column) -> Column:
        return F.array(F.struct(start.alias("start"), end.alias("end")))

    def join(done: Column, s: Column) -> Column:
        last, size = F.get(done, F.size(done) - 1), F.size(done)
        wider = one(last["start"], F.greatest(last["end"], s["end"]))
        return F.when(
            (size > 0) & (s["start"] <= last["end"]),
            F.concat(F.slice(done, F.lit(1), F.greatest(size - 1, F.lit(0))), wider),
        ).otherwise(F.concat(done, one(s["start"], s["end"])))

    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return F.aggregate(spans, none, join)


def redact(
    docs: DataFrame,
    text_column: str = "text",
    length_column: str = "n_chars",
    mask: str = "[SECRET]",
    **more,
) -> DataFrame:
    """The documents with each secret (overlapping ones together) replaced by a mask.

    Columns stay as they are; ``length_column``, if there, is set to the new length of a
    changed text.
    """
    found = find_secrets(docs, text_column, **more)
    changed = F.size("secrets") > 0
    found = found.withColumn("spans", F.when(changed, disjoint(F.col("secrets"))))
    ends = F.concat(
        F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["end"])
    )
    starts = F.concat(
        F.transform("spans", lambda s: s["start"]),
        F.array(F.char_length("text").cast("long")),
    )
    kept = F.zip_with(
        ends,
        starts,
        lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int")),
    )
    found = found.withColumn("redacted", F.when(changed, F.array_join(kept, mask)))
    columns, others = [], [c for c in docs.columns if c != text_column]
    for c in docs.columns:
        if c == text_column:
            value = F.coalesce("redacted", "text")
        else:
            value = F.col(f"row.c{others.index(c)}")
        if c == length_column:
            size = F.char_length("redacted").cast(docs.schema[c].dataType)
            value = F.when(changed, size).otherwise(value)
        columns.append(value.alias(c))
    return found.select(*columns)


# The query over the documents table, by the same definitions, one row per match.
ORACLE = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), patterns(kind, rank, pattern) AS (VALUES
    ('assign', 0, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+'),
    ('access', 1, 'AKIA[A-Z0-9]+'),
    ('hex', 2, '[0-9a-f]{{24,}}'),
    ('random', 3, '[A-Za-z0-9+/_=-]{{20,}}')
), found AS (
    SELECT row_id, kind, rank, regexp_extract_all(text, pattern) AS hits,
        string_split_regex(text, pattern) AS gaps
    FROM docs CROSS JOIN patterns
), placed AS (
    SELECT row_id, kind, rank, hits[i] AS token,
        list_sum(list_transform(range(1, i + 1), lambda j: length(gaps[j]) + length(hits[j]))) AS e
    FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM found WHERE len(hits) > 0)
), spans AS (
    SELECT row_id, kind, rank, token, cast(e - length(token) AS bigint) AS s, cast(e AS bigint) AS e
    FROM placed
), base AS (
    SELECT row_id, kind, rank, s, e FROM spans
    WHERE (kind = 'assign' AND length(regexp_extract(token, '[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 6)
        OR (kind = 'access' AND length(token) >= 20) OR kind = 'hex'
), tokens AS (
    SELECT * FROM spans t WHERE kind = 'random' AND NOT EXISTS (
        SELECT 1 FROM base b WHERE b.row_id = t.row_id AND b.s <= t.s AND t.e <= b.e)
), encodings(place, pattern, alphabet, effect) AS (VALUES
    (0, '^[0-9a-f]*[0-9][0-9a-f]*$', '{DIGITS}abcdef', 1.0::DOUBLE),
    (1, '^[0-9A-F]*[0-9][0-9A-F]*$', '{DIGITS}ABCDEF', 1.0),
    (2, '^[A-Z2-7]*[2-7][A-Z2-7]*$', '{UPPER}234567', 1.0),
    (3, '^[a-z]+$', '{LOWER}', 0.7), (4, '^[A-Z]+$', '{UPPER}', 0.7),
    (5, '^[a-z0-9]+$', '{LOWER}{DIGITS}', 1.3), (6, '^[A-Z0-9]+$', '{UPPER}{DIGITS}', 1.3),
    (7, '^[^+/]*[_-][^+/]*$', '{UPPER}{LOWER}{DIGITS}-_', 3.2),
    (8, '.*', '{UPPER}{LOWER}{DIGITS}+/', 3.2)
), bare AS (
    SELECT *, rtrim(token, '=') AS bare FROM tokens
), encoded AS (
    SELECT *, length(alphabet) AS k, length(t)::DOUBLE AS n, string_split(alphabet, '') AS letters
    FROM (
        SELECT b.*, c.alphabet, c.effect,
            regexp_replace(b.bare, '[^' || replace(c.alphabet, '-', '\-') || ']', '', 'g') AS t
        FROM bare b JOIN encodings c ON c.place = (
            SELECT min(x.place) FROM encodings x WHERE regexp_matches(b.bare, x.pattern)))
), sided AS (
    SELECT *, translate(t, alphabet, repeat('0', k // 2) || repeat('1', k - k // 2)) AS sides,
        list_transform(string_split(t, ''), lambda c: instr(alphabet, c)::DOUBLE) AS xs,
        list_sum(list_transform(letters, lambda c: pow(length(t) - length(replace(t, c, '')), 2)))
            * k / n - n AS chi
    FROM encoded WHERE n >= 2
), counted AS (
    SELECT *, (length(sides) - length(replace(sides, '0', '')))::DOUBLE AS c0,
        (length(sides) - length(replace(sides, '1', '')))::DOUBLE AS c1,
        1 + (length(sides) - length(replace(sides, '01', ''))) / 2
            + (length(sides) - length(replace(sides, '10', ''))) / 2 AS runs,
        list_sum(xs) / n AS mean
    FROM sided
), moments AS (
    SELECT *, 1 + 2 * c0 * c1 / (c0 + c1) AS m,
        list_sum(list_transform(xs, lambda x: x * x)) - mean * mean * n AS spread,
        list_sum(list_transform(range(1, len(xs)), lambda i: (xs[i] - mean) * (xs[i + 1] - mean))) AS lagged
    FROM counted
), tested AS (
    SELECT *, (m - 1) * (m - 2) / (c0 + c1 - 1) AS variance, k - 1 + n * effect AS a,
        k - 1 + 2 * n * effect AS b, k - 1 + 3 * n * effect AS c
    FROM moments
), powers AS (
    SELECT *, 1 - 2 * a * c / (3 * b * b) AS h, b / (a * a) AS p FROM tested
), roots AS (
    SELECT *, (h - 1) * (1 - 3 * h) AS w FROM powers
), valued AS (
    SELECT row_id, s, e,
        (pow(greatest(chi, 0.0) / a, h) - (1 + h * p * (h - 1 - (2 - h) * w * p / 2)))
            / (h * sqrt(2 * p) * (1 + w * p / 2)) AS z,
        coalesce(variance > 0 AND spread > 0
            AND abs((runs - m) / sqrt(greatest(variance, 1e-300))) < 3.3
            AND abs(lagged / greatest(spread, 1e-300) * sqrt(n - 1.0)) < 3.3, false) AS plain
    FROM roots
), tails AS (
    SELECT *, abs(z) AS v, abs(z) / sqrt(2.0) AS x, 1 / (1 + 0.3275911::DOUBLE * abs(z) / sqrt(2.0)) AS y
    FROM valued
), areas AS (
    SELECT *, y * (0.254829592::DOUBLE + y * (-0.284496736::DOUBLE + y * (1.421413741::DOUBLE
        + y * (-1.453152027::DOUBLE + y * 1.061405429::DOUBLE)))) * exp(-x * x) / 2 AS tail,
        exp(-x * x) / sqrt(2 * pi()) / (v + 1 / (v + 2 / (v + 3 / (v + 4 / (v + 5 / v))))) AS far
    FROM tails
), graded AS (
    SELECT row_id, s, e, cast(floor(log2(e - s)) AS int) AS size,
        cast(least(floor(-4 * log2(greatest(CASE WHEN NOT plain THEN 1.0 WHEN z < -5 THEN far
            WHEN z < 0 THEN tail ELSE 1 - tail END, pow(2.0, -500)))), 2000) AS int) AS grid
    FROM areas
    UNION ALL SELECT row_id, s, e, cast(floor(log2(e - s)) AS int), 0 FROM encoded WHERE n < 2
), grids AS (
    SELECT size, grid, count(*) AS n FROM graded GROUP BY size, grid
), cuts AS (
    SELECT size, min(grid) AS cut FROM (
        SELECT size, grid, sum(n) OVER (PARTITION BY size ORDER BY grid DESC) AS passed,
            sum(n) OVER (PARTITION BY size) AS total
        FROM grids)
    WHERE pow(2.0, -grid / 4.0) <= 0.01::DOUBLE * passed / total GROUP BY size
), kept AS (
    SELECT row_id, kind, rank, s, e FROM base
    UNION ALL SELECT row_id, 'random', 3, s, e FROM graded JOIN cuts USING (size) WHERE grid >= cut
), texts AS (
    SELECT row_id,
        count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex,
        coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3), '') AS base,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
    FROM kept GROUP BY row_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans
FROM docs d LEFT JOIN texts USING (row_id)
"""
