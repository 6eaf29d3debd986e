"""Secret scans: fixed patterns, and a battery of randomness tests on long runs of key-like characters.

Patterns find assignments of secrets, access keys and long hexadecimal runs. Besides, every run of key-like characters
is taken as written in the smallest alphabet that holds it (a run that none holds is taken apart at its separators), and tested against uniformly random symbols of that
alphabet: chi-squared uniformity of the counts, number of runs above and below the middle, and correlation of
neighbours. The three p-values are combined (Fisher). Random runs spread evenly over the p-values, others pile up near
zero; so in every class of alphabet and length, counted over the distinct runs of all documents, the share of others above a bar is known, and
the bar is set where it falls below the allowed rate of false discoveries. Short runs, which tests can hardly tell
apart, thus face a higher bar than long ones; runs of letters alone, as words are written, are tested only from a length
at which words no longer pass for random. DataFrame functions only.

Positions are code points, ends exclusive. What leaves a document are spans, never the secrets themselves.

Defined results: a NULL or empty text has no spans. Rows without doc_id and repeated rows are scanned like all others.
An empty table gives an empty result. Extra columns are not carried.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from clinflow.llm.text import whole
from clinflow.scratch import materialize

# The patterns, and the least length of what they match (of group 2 for an assignment).
ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

_LEAST = 20
_KEYLIKE = rf"[A-Za-z0-9+/_-]{{{_LEAST},}}={{0,2}}"
_DIGITS = "0123456789"
_SMALL = "abcdefghijklmnopqrstuvwxyz"
# Alphabets from the smallest to the largest: what a run is taken to be written in.
ALPHABETS = {
    "decimal": _DIGITS,
    "hex": _DIGITS + _SMALL[:6],
    "hex upper": _DIGITS + _SMALL[:6].upper(),
    "letters": _SMALL,
    "letters upper": _SMALL.upper(),
    "base32": _SMALL.upper() + "234567",
    "base36": _DIGITS + _SMALL,
    "base36 upper": _DIGITS + _SMALL.upper(),
    "letters both": _SMALL.upper() + _SMALL,
    "base62": _SMALL.upper() + _SMALL + _DIGITS,
    "base64": _SMALL.upper() + _SMALL + _DIGITS + "+/",
    "base64 url": _SMALL.upper() + _SMALL + _DIGITS + "-_",
}


@dataclass(frozen=True)
class SecretSettings:
    """``false_rate``: share of false runs allowed among the distinct ones the tests add. ``bins``: of the p-values.
    ``lengths``: where one class of lengths ends and the next begins. ``letters_from``: least length of runs of letters
    alone; at 32 the uneven letters of words lie over three standard errors off an even alphabet."""

    false_rate: float = 0.1
    bins: int = 20
    letters_from: int = 32
    lengths: tuple[int, ...] = (24, 32, 48, 64, 128)


_MATCHES = "array<struct<kind:int,place:int,gap:int,token:string>>"


def matches(text: Column, kind: str, pattern: str) -> Column:
    """[(kind, place, gap, token)] of all matches, left to right; ``gap`` is the length of what lies before the match."""
    between = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
    tokens = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(between, tokens, lambda gap, token: F.struct(gap.alias("gap"), token.alias("token")))
    # The piece after the last match has no match beside it.
    met = F.filter(pairs, lambda p: p["token"].isNotNull())
    rank = F.lit(KINDS.index(kind))
    placed = F.transform(met, lambda p, i: F.struct(rank.alias("kind"), i.alias("place"), p["gap"].alias("gap"), p["token"].alias("token")))
    return F.when(text.rlike(pattern), placed.cast(_MATCHES)).otherwise(F.array().cast(_MATCHES))


def in_parts(rows: DataFrame) -> DataFrame:
    """Put the parts of every run that no alphabet holds beside it: between its ``+/``, between its ``-_``, between all of them.

    Adds ``step``, what the row takes of the text from where the one before it ended, and ``back``, how far before the end
    of the run it starts. Parts take nothing; they carry the place of their run and follow it by ``part``.
    """
    token = F.col("token")
    mixed = token.rlike("[+/]") & token.rlike("[-_]")
    out = rows.withColumn("chars", F.when(mixed, F.filter(F.split(token, ""), lambda c: c != "")))
    # Bounds of parts: (where, 1 for +/, 2 for -_, 3 for either end of the run).
    bound = lambda at, side: F.struct(at.cast("int").alias("at"), F.lit(side).cast("int").alias("side"))
    cuts = F.transform("chars", lambda c, i: F.when(c.isin("+", "/"), bound(i, 1)).when(c.isin("-", "_"), bound(i, 2)))
    cuts = F.filter(cuts, lambda b: b.isNotNull())
    out = out.withColumn("bounds", F.concat(F.array(bound(F.lit(-1), 3)), cuts, F.array(bound(F.size("chars"), 3))))
    outer = F.filter("bounds", lambda b: b["side"] != 2)
    inner = F.filter("bounds", lambda b: b["side"] != 1)
    out = out.withColumns({"outer": outer, "inner": inner})

    def between(bounds: str, all_of_them: bool) -> Column:
        pairs = F.zip_with(
            F.slice(bounds, F.lit(1), F.size(bounds) - 1), F.slice(bounds, F.lit(2), F.size(bounds) - 1),
            lambda a, b: F.struct((a["at"] + 1).alias("from"), (b["at"] - a["at"] - 1).alias("length"), a["side"].bitwiseAND(b["side"]).alias("same")),
        )
        # A part between two bounds of one side is found by that side.
        return F.filter(pairs, lambda x: (x["length"] >= _LEAST) & (F.lit(not all_of_them) | (x["same"] == 0)))

    out = out.withColumn("places", F.concat(between("outer", False), between("inner", False), between("bounds", True)))
    parts = F.transform(
        "places",
        lambda x, i: F.struct(
            (i + 1).alias("part"), F.lit(0).alias("step"), (F.col("length") - x["from"]).alias("back"), x["length"].alias("length"),
            F.array_join(F.slice("chars", x["from"] + 1, x["length"]), "").alias("token"),
        ),
    )
    itself = F.struct(F.lit(0).alias("part"), (F.col("gap") + F.col("length")).alias("step"), F.col("length").alias("back"), F.col("length"), token)
    type_ = "array<struct<part:int,step:int,back:int,length:int,token:string>>"
    every = F.concat(F.array(itself).cast(type_), F.coalesce(parts.cast(type_), F.array().cast(type_)))
    kept = [name for name in rows.columns if name not in ("gap", "length", "token")]
    return out.select(*kept, F.inline(every))


def _long_enough() -> Column:
    """Whether a match of a fixed pattern counts; the text that a short one took stays taken."""
    assigned = F.char_length(F.regexp_extract("token", ASSIGN, 2)) >= 8
    access = F.char_length("token") >= 16
    return F.when(F.col("kind") == KINDS.index("assign"), assigned).when(F.col("kind") == KINDS.index("access"), access).otherwise(True)


def _above(z: Column) -> Column:
    """Share of a standard normal above z, to some 1e-4."""
    return 1 / (1 + F.exp(F.greatest(F.least(1.5976 * z + 0.070566 * z * z * z, F.lit(700.0)), F.lit(-700.0))))


def _evidence(p: Column) -> Column:
    return -F.log(F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-300)))


def randomness(runs: DataFrame) -> DataFrame:
    """Add ``written``, the place of the alphabet the ``token`` is written in (NULL if none holds it), and ``p``, the
    p-value of the three tests together if every symbol were drawn evenly from that alphabet.

    One step per column, so that no step is computed again within another.
    """
    alphabets = list(ALPHABETS.values())
    written = F.lit(None).cast("int")
    for place in reversed(range(len(alphabets))):
        written = F.when(F.translate("token", alphabets[place], "") == "", place).otherwise(written)
    out = runs.withColumn("written", written)
    out = out.withColumn("letters", F.get(F.array(*map(F.lit, alphabets)), F.col("written")))
    out = out.withColumns({"size": F.char_length("letters").cast("double"), "n": F.char_length("token").cast("double")})
    every = F.filter(F.split("token", ""), lambda c: c != "")
    out = out.withColumn("places", F.transform(every, lambda c: (F.position(c, F.col("letters")) - 1).cast("double")))
    distinct = F.array_distinct("places")
    counts = F.transform(distinct, lambda x: F.size(F.filter("places", lambda y: y == x)).cast("double"))
    neighbours = F.zip_with(
        F.slice("places", F.lit(1), F.size("places") - 1),
        F.slice("places", F.lit(2), F.size("places") - 1),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )
    out = out.withColumns({"counts": counts, "pairs": neighbours, "middle": (F.col("size") - 1) / 2})
    changed = F.filter("pairs", lambda p: (p["a"] > F.col("middle")) != (p["b"] > F.col("middle")))
    product = F.aggregate("pairs", F.lit(0.0), lambda s, p: s + (p["a"] - F.col("middle")) * (p["b"] - F.col("middle")))
    out = out.withColumns(
        {
            "squares": F.aggregate("counts", F.lit(0.0), lambda s, c: s + c * c),
            "changes": F.size(changed).cast("double"),
            "product": product,
            "freedom": F.col("size") - 1,
            "high": F.floor(F.col("size") / 2) / F.col("size"),
        }
    )
    size, n, freedom = F.col("size"), F.col("n"), F.col("freedom")
    out = out.withColumns(
        {
            "chi": size * F.col("squares") / n - n,
            "spread": 2 / (9 * freedom),
            "change": 2 * F.col("high") * (1 - F.col("high")),
        }
    )
    change, spread = F.col("change"), F.col("spread")
    # Chi-squared by its cube root, which is close to normal.
    uniform = _above((F.pow(F.greatest(F.col("chi"), F.lit(0.0)) / freedom, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread))
    runs_off = (F.col("changes") - (n - 1) * change) / F.sqrt((n - 1) * change * (1 - change))
    serial = F.col("product") / (F.sqrt(n - 1) * (size * size - 1) / 12)
    out = out.withColumn("evidence", _evidence(uniform) + _evidence(2 * _above(F.abs(runs_off))) + _evidence(2 * _above(F.abs(serial))))
    evidence = F.col("evidence")
    # Fisher: twice the evidence is chi-squared with six degrees of freedom.
    return out.select(*runs.columns, "written", (F.exp(-evidence) * (1 + evidence + evidence * evidence / 2)).alias("p"))


def _classed(runs: DataFrame, settings: SecretSettings) -> DataFrame:
    """Add ``class``, of alphabet and length, and ``bin``, of the p-value."""
    long_as = sum((F.when(F.char_length("token") >= n, 1).otherwise(0) for n in settings.lengths), F.lit(0))
    place = F.least(F.floor(F.col("p") * settings.bins), F.lit(settings.bins - 1)).cast("int")
    tested = randomness(runs.withColumn("token", F.rtrim("token", F.lit("="))))
    group = F.col("written") * (len(settings.lengths) + 1) + long_as
    letters = [i for i, name in enumerate(ALPHABETS) if name.startswith("letters")]
    telling = ~F.col("written").isin(letters) | (F.char_length("token") >= settings.letters_from)
    return tested.withColumns({"class": group.cast("int"), "bin": F.when(telling, place)})


def _bars(runs: DataFrame, settings: SecretSettings) -> dict[int, float]:
    """class -> least p that counts as random. Classes are few and fixed; only their counts reach the driver.

    A run counts once, however often it is copied: copies are no further tests. Where the bar lets everything in, it
    still keeps out what is too far off to be one of that many random runs.
    """
    each = runs.filter(F.col("bin").isNotNull()).select("class", "bin", "mark").distinct().groupBy("class", "bin").count()
    counts: dict[int, list[int]] = {}
    for row in each.collect():
        counts.setdefault(row["class"], [0] * settings.bins)[row["bin"]] = row["count"]
    bars = {}
    for group, bins in counts.items():
        random = min(sum(bins), 2 * sum(bins[settings.bins // 2 :]))
        for bar in range(settings.bins):
            found = sum(bins[bar:])
            false = found - random * (1 - bar / settings.bins)
            if found and false <= settings.false_rate * found:
                bars[group] = bar / settings.bins or min(settings.false_rate / max(random, 1), 1 / settings.bins)
                break
    return bars


def scan(docs: DataFrame, settings: SecretSettings = SecretSettings()) -> DataFrame:
    """(doc_id, base, added): spans (start, kind, end) of the patterns, and of random runs that lie in none of them.

    The text is read once. Every match becomes a narrow row of its own, and every document one more; where a match
    starts follows from the lengths before it, summed up within the document.
    """
    text = F.col("text")
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "random": _KEYLIKE}
    marker = F.array(F.struct(F.lit(-1), F.lit(0), F.lit(0), F.lit(""))).cast(_MATCHES)
    every = F.concat(marker, *[matches(text, kind, pattern) for kind, pattern in patterns.items()])
    found = docs.select("doc_id", whole("text").alias("text"))
    found = found.select("doc_id", F.monotonically_increasing_id().alias("number"), every.alias("found"))
    rows = found.select("number", "doc_id", F.inline("found"))
    random = F.col("kind") == KINDS.index("random")
    rows = rows.withColumns({"length": F.char_length("token"), "counted": _long_enough()})
    rows = _classed(in_parts(rows.withColumn("token", F.when(random, F.col("token")))), settings)
    scanned = materialize(rows.select("number", "doc_id", "kind", "place", "part", "step", "back", "length", "counted", "class", "bin", "p", F.xxhash64("token").alias("mark")), "secrets")

    bars = _bars(scanned, settings)
    random_enough = F.lit(False)
    if bars:
        least = F.create_map(*[F.lit(x) for pair in sorted(bars.items()) for x in pair])
        random_enough = F.coalesce(F.col("bin").isNotNull() & (F.col("p") >= F.try_element_at(least, F.col("class"))), F.lit(False))
    before = Window.partitionBy("number", "kind").orderBy("place", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = scanned.repartition("number").withColumn("start", (F.sum("step").over(before) - F.col("back")).cast("int"))
    placed = placed.withColumn("end", F.col("start") + F.col("length"))
    base = F.col("kind").between(0, 2) & F.col("counted")
    # A run lies in a span of a pattern if one that starts no later ends no earlier.
    sofar = Window.partitionBy("number").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("reach", F.max(F.when(base, F.col("end"))).over(sofar))
    # Nor is a part of a run added where a larger part of it is.
    larger = Window.partitionBy("number").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("within", F.max(F.when(random & random_enough, F.col("end"))).over(larger))
    free = [F.col(name).isNull() | (F.col(name) < F.col("end")) for name in ("reach", "within")]
    added = random & random_enough & free[0] & free[1]
    span = F.struct("start", "kind", "end")
    spans = [F.array_sort(F.collect_list(F.when(chosen, span))).alias(name) for name, chosen in (("base", base), ("added", added))]
    return placed.groupBy("number").agg(F.first("doc_id").alias("doc_id"), *spans).drop("number")


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
