"""Secret scans: known shapes, and long tokens that a battery of randomness tests takes for keys.

All of it is SQL expressions. A token gets the encoding its characters fit. Against ordinary strings of
that encoding, which repeat some characters more than others, its repeats are compared with what
chi-squared uniformity leads one to expect; runs and serial correlation must look random as well. The
longer the token, the smaller its p-value can be, and the rate of false discoveries is held within
each class of lengths over all tokens of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.columns import own_name, put

# The shapes of known secrets and the least length of what must match.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LENGTH = 20
HEX = r"[0-9a-f]+"
HEX_LENGTH = 24
KINDS = ("assign", "access", "hex", "random")
SPAN = "array<struct<start:int,end:int,value:string>>"
PLACEHOLDER = "[secret]"

# What may be a key, and the encodings in the order they are tried: name, what fits, alphabet, and the
# chance that two characters of an ordinary string of that encoding are equal.
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
ENCODINGS = (
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", "0123456789abcdef", 0.1),
    ("HEX", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", "0123456789ABCDEF", 0.1),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.065),
    ("lower", r"^[a-z]+$", "abcdefghijklmnopqrstuvwxyz", 0.065),
    ("upper", r"^[A-Z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", 0.065),
    (
        "base64",
        r"^(?=.*[A-Za-z]).+$",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
        0.0625,
    ),
)
# Spread of the letter frequencies of ordinary strings, for the variance of their repeats.
FREQUENCY_SPREAD = 0.0018
# A token whose chi-squared, runs or serial correlation is this unlikely for a random one is none.
NOT_RANDOM = 0.003
FALSE_DISCOVERIES = 0.01
# p-values are ranked in steps of a tenth of a power of ten, down to the last step.
STEPS = 400


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by the usual five-term rational approximation."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    small = series * F.exp(-x * x / 2) * 0.3989422804014327
    return F.when(z >= 0, small).otherwise(1 - small)


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return total / F.greatest(F.size(values), F.lit(1))


def token_p_value(token: Column) -> Column:
    """How likely an ordinary string of the encoding that the token fits repeats characters as little.

    One if no encoding fits, or if chi-squared, runs or serial correlation are not those of a random
    string.
    """
    chosen = F.struct(F.lit(None).cast("string").alias("alphabet"), F.lit(None).cast("double").alias("ordinary"))
    for _, fits, alphabet, ordinary in reversed(ENCODINGS):
        own = F.struct(F.lit(alphabet).alias("alphabet"), F.lit(ordinary).alias("ordinary"))
        chosen = F.when(token.rlike(fits), own).otherwise(chosen)
    plain = F.translate(F.rtrim(token, F.lit("=")), "-_", "+/")
    chars = F.filter(F.split(plain, ""), lambda c: c != "")

    def place(encoding: Column) -> Column:
        index = F.transform(chars, lambda c: F.greatest(F.instr(encoding["alphabet"], c) - 1, F.lit(0)).cast("double"))
        return F.struct(index.alias("index"), F.length(encoding["alphabet"]).cast("double").alias("k"), encoding["ordinary"].alias("ordinary"))

    def centre(placed: Column) -> Column:
        return F.struct(*[placed[c].alias(c) for c in ("index", "k", "ordinary")], _mean(placed["index"]).alias("mean"))

    def tests(placed: Column) -> Column:
        index, k, ordinary, mean = (placed[c] for c in ("index", "k", "ordinary", "mean"))
        n = F.size(index).cast("double")
        counts = F.transform(
            F.sequence(F.lit(0), k.cast("int") - 1), lambda j: F.size(F.filter(index, lambda x: x == j)).cast("double")
        )
        half = F.transform(index, lambda x: F.when(x >= k / 2, 1.0).otherwise(0.0))
        return F.struct(
            n.alias("n"),
            k.alias("k"),
            ordinary.alias("ordinary"),
            F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c).alias("squares"),
            F.aggregate(half, F.lit(0.0), lambda a, x: a + x).alias("high"),
            F.aggregate(_neighbours(half, lambda a, b: F.abs(a - b)), F.lit(1.0), lambda a, x: a + x).alias("runs"),
            F.aggregate(index, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)).alias("power"),
            F.aggregate(_neighbours(index, lambda a, b: (a - mean) * (b - mean)), F.lit(0.0), lambda a, x: a + x).alias("serial"),
        )

    def decide(t: Column) -> Column:
        n, k, ordinary, squares = t["n"], t["k"], t["ordinary"], t["squares"]
        repeats = F.try_divide(squares - n, n * (n - 1))
        spread = F.try_divide(F.lit(4 * FREQUENCY_SPREAD), n) + F.try_divide(2 * ordinary * (1 - ordinary), n * n)
        p_ordinary = _tail(F.try_divide(ordinary - repeats, F.sqrt(spread)))
        # Wilson and Hilferty: the cube root of chi-squared over its mean is nearly normal.
        chi, few = F.try_divide(squares * k, n) - n, F.try_divide(F.lit(2.0), 9 * (k - 1))
        p_chi = _tail(F.try_divide(F.pow(F.try_divide(chi, k - 1), F.lit(1 / 3)) - (1 - few), F.sqrt(few)))
        runs_mean = 1 + F.try_divide(2 * t["high"] * (n - t["high"]), n)
        runs_spread = F.try_divide((runs_mean - 1) * (runs_mean - 2), n - 1)
        p_runs = F.when(runs_spread > 0, 2 * _tail(F.try_divide(F.abs(t["runs"] - runs_mean), F.sqrt(runs_spread)))).otherwise(0.0)
        lag = F.abs(F.try_divide(t["serial"], t["power"]) + F.try_divide(F.lit(1.0), n)) * F.sqrt(n)
        p_serial = F.when(t["power"] > 0, 2 * _tail(lag)).otherwise(0.0)
        random = F.least(p_chi, p_runs, p_serial) >= NOT_RANDOM / 3
        return F.coalesce(F.when(random, p_ordinary), F.lit(1.0))

    # Arrays of one element, so that what later steps look at more than once is made once.
    steps = F.array(chosen)
    for step in (place, centre, tests, decide):
        steps = F.transform(F.filter(steps, lambda e: e["ordinary"].isNotNull()), step)
    return F.coalesce(F.get(steps, 0), F.lit(1.0))


def _neighbours(values: Column, combine) -> Column:
    few = F.greatest(F.size(values) - 1, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), few), F.slice(values, F.lit(2), few), combine)


def _length_class(token: Column) -> Column:
    return F.floor(F.log2(F.length(token))).cast("int")


def _step(p: Column) -> Column:
    """Number of whole tenths of powers of ten that ``p`` is below one, rounded against discovery."""
    return F.least(F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-40)))), F.lit(STEPS)).cast("int")


def discovery_steps(docs: DataFrame, text: str = "text") -> dict[int, int]:
    """For each class of lengths the least step that counts as a discovery.

    Benjamini and Hochberg's rule over all tokens of the table: in a class of m tokens a step holds when
    the share of tokens at or beyond it is at least its p-value over the permitted rate. Tokens are
    counted by class and step, which is a table of a few hundred rows however many tokens there are.
    """
    found = docs.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(TOKEN), 0)).alias("token"))
    counted = found.groupBy(
        _length_class(F.col("token")).alias("length_class"), _step(token_p_value(F.col("token"))).alias("step")
    ).count()
    rows, least = counted.collect(), {}
    for kind in {row["length_class"] for row in rows}:
        own = {row["step"]: row["count"] for row in rows if row["length_class"] == kind}
        total, beyond = sum(own.values()), 0
        for step in sorted(own, reverse=True):
            beyond += own[step]
            if 10 ** (-step / 10) <= FALSE_DISCOVERIES * beyond / total:
                least[kind] = step
    return least


def _matches(text: Column, pattern: str) -> Column:
    """Leftmost matches that do not overlap, as spans in code points with their values.

    The pieces between matches and the matches themselves follow each other, so their lengths give
    the positions.
    """
    pieces = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), 0)
    zipped = F.zip_with(F.slice(pieces, F.lit(1), F.size(values)), values, lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def add(found, piece):
        first = found["at"] + piece["gap"]
        last = first + F.length(piece["value"])
        span = F.struct(first.alias("start"), last.alias("end"), piece["value"].alias("value"))
        return F.struct(last.alias("at"), F.concat(found["spans"], F.array(span)).alias("spans"))

    return F.aggregate(zipped, start, add, lambda found: found["spans"])


def _when_any(text: Column, quick: Column, spans: Column) -> Column:
    return F.when(text.isNotNull() & quick, spans).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of the known shapes. A failing match still takes its place and is then dropped."""
    return {
        "assign": _when_any(
            text,
            text.rlike(ASSIGN),
            F.filter(_matches(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_VALUE),
        ),
        "access": _when_any(
            text, F.contains(text, F.lit("AKIA")), F.filter(_matches(text, ACCESS), lambda s: s["end"] - s["start"] >= ACCESS_LENGTH)
        ),
        # A run of hexadecimal digits is taken whole, so asking for its length in the pattern is the same.
        "hex": _when_any(text, text.rlike(f"[0-9a-f]{{{HEX_LENGTH}}}"), _matches(text, f"[0-9a-f]{{{HEX_LENGTH},}}")),
    }


def random_spans(text: Column, steps: dict[int, int]) -> Column:
    """Spans of tokens whose p-value is a discovery for their length."""
    if not steps:
        return F.array().cast(SPAN)
    least = F.create_map(*[F.lit(x) for pair in sorted(steps.items()) for x in pair])

    def found(token: Column) -> Column:
        return F.coalesce(_step(token_p_value(token)) >= F.element_at(least, _length_class(token)), F.lit(False))

    return _when_any(text, text.rlike(TOKEN), F.filter(_matches(text, TOKEN), lambda s: found(s["value"])))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later columns look at without computing it again: an explode of one element,
    which the optimizer does not merge into what follows."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def scan_secrets(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """Add ``out``, an array of ``(kind, start, end)`` by start and then kind, in code points.

    NULL and empty texts have none. Found tokens that touch a known shape are left to it. Other columns
    stay, one named ``out`` is replaced; rows that repeat are scanned alike. The rule for discoveries
    counts the tokens of all rows; without tokens nothing is discovered.
    """
    mark = own_name(docs, "spans")
    steps = discovery_steps(docs.select(docs[f"`{text}`"].alias("text")))
    known = base_spans(docs[f"`{text}`"])
    parts = [*[spans.alias(kind) for kind, spans in known.items()], random_spans(docs[f"`{text}`"], steps).alias("random")]
    scanned = _once(docs, mark, F.struct(*parts))
    base = F.flatten(F.array(*[F.col(f"{mark}.{kind}") for kind in KINDS[:3]]))
    apart = F.filter(
        F.col(f"{mark}.random"),
        lambda r: ~F.exists(base, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])),
    )

    def named(number: int, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("number"), s["end"].alias("end")))

    parts = [*(F.col(f"{mark}.{kind}") for kind in KINDS[:3]), apart]
    ordered = F.sort_array(F.concat(*[named(i, spans) for i, spans in enumerate(parts)]))
    kinds = F.array(*map(F.lit, KINDS))
    shown = F.transform(
        ordered, lambda s: F.struct(F.get(kinds, s["number"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )
    return put(scanned, {out: shown}).drop(mark)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` with every found span of ``text`` replaced by a placeholder.

    Spans that touch become one placeholder. ``n_chars``, if there is one, follows the new text. Rows
    without a find are as before, NULL texts included.
    """
    spans = own_name(docs, "secrets")
    found = _once(scan_secrets(docs, text, f"{spans}_all"), spans, F.col(f"{spans}_all"))
    whole = found[f"`{text}`"]
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(done, span):
        fresh = span["start"] >= done["at"]
        piece = F.concat(done["out"], F.substring(whole, done["at"] + 1, span["start"] - done["at"]), F.lit(PLACEHOLDER))
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"), F.when(fresh, piece).otherwise(done["out"]).alias("out")
        )

    clean = F.aggregate(
        F.col(spans), start, add, lambda done: F.concat(done["out"], F.substring(whole, done["at"] + 1, F.lit(2**31 - 1)))
    )
    changed = F.size(spans) > 0
    body = own_name(docs, "clean")
    found = _once(found, body, F.when(changed, clean).otherwise(whole))
    columns = []
    for c in docs.columns:
        value = found[f"`{c}`"]
        if c == text:
            value = F.col(body)
        elif c.lower() == "n_chars":
            value = F.when(changed, F.length(body).cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return found.select(*columns)
