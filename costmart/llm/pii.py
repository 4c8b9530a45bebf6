r"""Personal data by boosted candidates.

Strict patterns give the base spans (email, ip, card, phone). Generators of
high recall then propose spans of any form that comes near: obfuscated email
addresses, digit runs with all sorts of separators, defanged dotted quads, and
colon-separated hex (IPv6, which has no strict pattern). Boosted trees score
each candidate by its format and its context, and those above a calibrated
threshold that meet no base span are added.

The trees learn from the corpus, not from the strict patterns' verdict on a
candidate. What holds are planted forms: every base span of the corpus is
rewritten in a way in which people disguise such data (``_disguised``: at and
dot spelled out or bracketed, other separators, no plus sign) and seen in its
own context. What does not hold are the corpus' own candidates that the strict
patterns refuse: numbers that fail a checksum, parts of keys, prose around the
word "at" (hex: what is no valid address). Half of the documents (by hash)
train, the other half calibrates, over all rows, as counts of feature
combinations; the threshold is the lowest that keeps a precision of PRECISION
on the calibrating half. Data that the corpus itself holds in disguise counts
among the refused candidates: forms are found as long as they are rarer, by
that precision, than plain ones.

Everything is DataFrame functions; a document's matches and their places come
from splitting its text at a pattern. The patterns use possessive repeats and
start at the beginning of a run (or the end of the last match), which matches
the same strings as the plain forms without their quadratic time and deep
recursion on long runs.

Places are code points from 0, ends exclusive. Defined results: null and empty
texts have no spans; repeated rows repeat their result; of candidates that
overlap, one stays unless it meets a better one: of higher score, then of
earlier start, then of the kind that comes first; an empty table gives an empty
result and trains nothing. Only id and text are read. Overlaps are found by
sorting a text's likely candidates, so a text may have any number of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import boosting
from .common import written

KINDS = ["email", "ip", "card", "phone"]
PRECISION = 0.9  # that the threshold is calibrated to; disguised data in the corpus itself counts against it
CONTEXT = 24  # characters to the left

_RUN = r"(?:(?<![{0}])|\G)[{0}]++"
EMAIL = _RUN.format("A-Za-z0-9._%+-") + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = _RUN.format("0-9") + r"\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = r"(?:0++(?![0-9])|0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9]))"

LOOSE_MAIL = (
    r"[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\]|\{at\}|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}+"
    r"(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\}|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}+){1,8}"
)
LOOSE_DIGITS = r"[+(]?+(?<![0-9])[0-9](?:[\x20().\-/]{0,2}+[0-9]){6,}+"
# not a part of a longer word or run of groups; ends in a group or ::
LOOSE_HEX = (
    r"(?<![0-9A-Za-z:])(?=:{0,2}[0-9A-Fa-f])(?:[0-9A-Fa-f]{0,4}:){2,8}(?:[0-9A-Fa-f]{1,4}|(?<=::))"
    r"(?![0-9A-Za-z]|:[0-9A-Za-z:])"
)
LOOSE_QUAD = (
    r"(?<![0-9A-Za-z.])[0-9]{1,3}+(?:\x20?(?:\[\.\]|\(\.\)|\{\.\}|\[dot\]|\(dot\)|\{dot\}|\x20dot\x20|\x20\.\x20)\x20?"
    r"[0-9]{1,3}+){3}(?![0-9A-Za-z])"
)
_GROUPS = "[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})"
IPV6 = rf"^(?:{_GROUPS}{{7}}|(?:{_GROUPS}*)?::(?:{_GROUPS}*)?)$"  # with at most 7 groups beside ::

FEATURES = [
    "generator", "digits", "separators", "groups", "words", "left_kind", "right_kind", "form", "check",
]
GENERATORS = ("mail", "digits", "hex", "quad")


def _triggers(text: Column) -> dict[str, tuple[Column, str]]:
    """(condition without which the pattern cannot match, pattern) by name."""
    number = text.rlike("[0-9]")
    at = text.contains("@") | text.contains("(at)") | text.contains("[at]") | text.contains("{at}") | text.contains(" at ")
    return {
        "email": (text.contains("@"), EMAIL),
        "ip": (text.rlike(r"[0-9]\.[0-9]"), IP),
        "card": (number, CARD),
        "phone": (text.contains("+"), PHONE),
        "mail": (at & (text.contains(".") | text.contains("dot")), LOOSE_MAIL),
        "digits": (number, LOOSE_DIGITS),
        "hex": (text.rlike(":[0-9A-Fa-f]{0,4}:"), LOOSE_HEX),
        "quad": (text.rlike(r"[0-9]\x20?[\[({\x20]"), LOOSE_QUAD),
    }


def matches(docs: DataFrame, patterns: dict[str, tuple[Column, str]], text: str) -> DataFrame:
    """``docs`` with, for each pattern, an array of its matches (start, stop, hit, before, after).

    The text between matches and the matches alternate, so running sums of
    their lengths are the places. They are summed by blocks of about the root
    of their number, as appending to an array copies it.
    """
    none = F.array().cast("array<string>")
    for name, (possible, pattern) in patterns.items():
        docs = docs.withColumn(f"{name}_gaps", F.when(possible, F.split(text, pattern, -1)).otherwise(none))
        docs = docs.withColumn(
            f"{name}_hits", F.when(possible, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
        )
    docs = docs.drop(text)
    out_type = "array<struct<start:int,stop:int,hit:string,before:string,after:string>>"
    for name in patterns:
        gaps, hits = F.col(f"{name}_gaps"), F.col(f"{name}_hits")
        docs = docs.withColumn(
            f"{name}_zip",
            F.arrays_zip(
                gaps.alias("gap"),
                F.slice(gaps, F.lit(2), F.greatest(F.size(gaps), F.lit(1))).alias("next"),
                hits.alias("hit"),
            ),
        ).drop(f"{name}_gaps", f"{name}_hits")

        def place(state: Column, x: Column) -> Column:
            start = state["at"] + F.length(x["gap"])
            stop = start + F.length(x["hit"])
            found = F.struct(
                start.alias("start"),
                stop.alias("stop"),
                x["hit"].alias("hit"),
                F.right(x["gap"], F.lit(CONTEXT)).alias("before"),
                F.substring(x["next"], 1, 1).alias("after"),
            )
            moved = F.struct(stop.alias("at"), F.array_append(state["found"], found).alias("found"))
            return F.when(x["hit"].isNull(), state).otherwise(moved)

        docs = _placed(docs, name, place, out_type)
    return docs


def _placed(docs: DataFrame, name: str, place, out_type: str) -> DataFrame:
    """``name``: the matches of ``<name>_zip`` with their places, block by block."""
    zipped, each, sums, starts = (f"{name}_{x}" for x in ("zip", "block", "sums", "starts"))
    size = lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0))
    block = lambda k: F.slice(zipped, k * F.col(each) + 1, F.col(each))
    blocks = F.ceil(F.size(zipped) / F.col(each)).cast("int")
    numbers = F.when(blocks > 0, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array().cast("array<int>"))
    docs = docs.withColumn(each, F.greatest(F.ceil(F.sqrt(F.size(zipped))), F.lit(1)).cast("int"))
    docs = docs.withColumn(
        sums, F.transform(numbers, lambda k: F.aggregate(block(k), F.lit(0), lambda n, x: n + size(x)))
    )
    docs = docs.withColumn(
        starts,
        F.aggregate(
            sums, F.array(F.lit(0)), lambda a, n: F.array_append(a, F.element_at(a, -1) + n)
        ),
    )

    def within(k: Column) -> Column:
        begin = F.struct(F.get(F.col(starts), k).alias("at"), F.array().cast(out_type).alias("found"))
        return F.aggregate(block(k), begin, place)["found"]

    return docs.withColumn(name, F.flatten(F.transform(numbers, within))).drop(zipped, each, sums, starts)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    worth = F.transform(
        each,
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(rf"^(?:{OCTET}\.){{3}}{OCTET}$")
    n = F.length(_digits(hit))
    if kind == "card":
        return F.when((n >= 16) & (n <= 19), luhn(_digits(hit))).otherwise(False)
    if kind == "phone":
        return (n >= 8) & (n <= 15)
    return F.lit(True)


def _base(kind: str) -> Column:
    """The kind's valid matches as (kind number, start, stop)."""
    return F.transform(
        F.filter(kind, lambda m: _valid(kind, m["hit"])),
        lambda m: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), m["start"].alias("start"), m["stop"].alias("stop")
        ),
    )


def _side(char: Column) -> Column:
    """0: edge or white space, 1: word character, 2: other."""
    return F.when((F.length(char) == 0) | char.rlike(r"^\s$"), 0).when(char.rlike(r"^[\p{L}0-9_]$"), 1).otherwise(2)


def _is_card(hit: Column, n: Column) -> Column:
    """Whether a run of ``n`` digits is a candidate for a card, not a phone."""
    return (n >= 13) & ~hit.startswith("+")


def _hex_groups(hit: Column) -> Column:
    return F.size(F.filter(F.split(hit, ":"), lambda x: x != ""))


def _octets(hit: Column) -> Column:
    """Whether the digit groups are four of at most 255."""
    parts = F.filter(F.split(hit, "[^0-9]+"), lambda x: x != "")
    return (F.size(parts) == 4) & ~F.exists(parts, lambda x: (F.length(x) > 3) | (x.cast("int") > 255))


def _features(name: str, m: Column) -> dict[str, Column]:
    """Small whole numbers that say how a candidate is written and what stands around it."""
    hit, before = m["hit"], F.lower(m["before"])
    n = F.length(_digits(hit))
    zero = F.lit(0)
    groups = F.least(F.size(F.filter(F.split(hit, "[^0-9]+"), lambda x: x != "")), F.lit(6))
    if name == "mail":
        # how the at, and the last dot, are written: as such, in brackets, as a word, with a space
        form = (
            F.when(hit.rlike(r"[(\[{]at[)\]}]"), 1).when(hit.rlike(r"\x20at\x20"), 2).when(hit.rlike(r"\x20@|@\x20"), 3)
            .otherwise(0)
        )
        separated = (
            F.when(hit.rlike(r"[(\[{]dot[)\]}]"), 1).when(hit.rlike(r"\x20dot\x20"), 2).when(hit.rlike(r"\x20\.|\.\x20"), 3)
            .otherwise(0)
        )
        last = F.regexp_extract(hit, "([A-Za-z0-9-]*)$", 1)
        # an ending of two or three small letters; a name with a mark or number before the at
        check = F.when(last.rlike("^[a-z]{2,3}$"), 2).otherwise(0) + F.when(hit.rlike(r"^[^\x20@(\[{]*[0-9._%+-]"), 1).otherwise(0)
        groups = zero
    elif name == "digits":
        form = F.when(hit.startswith("+"), 1).when(hit.startswith("00"), 2).when(hit.contains("("), 3).otherwise(0)
        separators = F.regexp_replace(hit, "[0-9+()]", "")
        # none, single blanks and hyphens, single dots, single slashes, two in a row
        separated = (
            F.when(F.length(separators) == 0, 0).when(F.regexp_replace(hit, "[()]", "").rlike("[0-9][^0-9]{2}"), 4)
            .when(separators.rlike(r"^[\x20-]+$"), 1).when(separators.rlike(r"^\.+$"), 2).otherwise(3)
        )
        # a card's checksum; a dotted quad; a day of a calendar
        date = hit.rlike(r"^(?:19|20)[0-9]{2}[-/.\x20][01]?[0-9][-/.\x20][0-3]?[0-9](?:[^0-9]|$)")
        check = F.when((n >= 16) & (n <= 19), F.when(luhn(_digits(hit)), 1).otherwise(0)).otherwise(
            F.when(_octets(hit), 2).when(date, 3).otherwise(0)
        )
    elif name == "quad":
        form = F.when(hit.rlike(r"[(\[{]"), 1).when(hit.contains("dot"), 2).otherwise(0)
        separated, groups = zero, zero
        check = F.when(_octets(hit), 1).otherwise(0)
    else:
        form = F.when(hit.contains("::"), 1).otherwise(0)
        separated, check = zero, zero
        groups = F.least(_hex_groups(hit), F.lit(9))
    digits = (
        F.when(n <= 6, 0).when(n <= 9, 1).when(n <= 11, 2).when(n == 12, 3).when(n <= 15, 4).when(n == 16, 5)
        .when(n <= 19, 6).otherwise(7)
    )
    return {
        "generator": F.lit(GENERATORS.index(name)),
        "digits": zero if name in ("mail", "quad") else digits,
        "separators": separated,
        "groups": groups,
        "words": F.when(before.rlike(r"(tel|phone|call|fax|mobil|appel|llam)[^\s]*\s*$"), 1)
        .when(before.rlike(r"(card|visa|iban|account|konto|cuenta|carte|tarjeta)[^\s]*\s*$"), 2)
        .when(before.rlike(r"(mail|contact|kontakt|correo|courriel)[^\s]*\s*$"), 3)
        .when(before.rlike("[=:\"'#/]\\s?$"), 4).otherwise(0),
        "left_kind": _side(F.right(m["before"], F.lit(1))),
        "right_kind": _side(m["after"]),
        "form": form,
        "check": check,
    }


def _strict(name: str, hit: Column, n: Column) -> Column:
    """Whether a generator's match is, or holds, a base span of its kind."""
    if name == "mail":
        return hit.rlike(EMAIL)
    if name == "digits":
        card = hit.rlike(f"^{CARD}$") & _valid("card", hit)
        phone = hit.rlike(f"^{PHONE}$") & _valid("phone", hit)
        return F.when(_is_card(hit, n), card).otherwise(phone)
    return F.lit(False)


def _ipv6(hit: Column) -> Column:
    return hit.rlike(IPV6) & (~hit.contains("::") | (_hex_groups(hit) <= 7))


def _shaped(name: str, m: Column, holds: Column) -> Column:
    """A generator's match as (kind, start, stop, x, holds)."""
    n = F.length(_digits(m["hit"]))
    kind = {
        "mail": F.lit(KINDS.index("email")),
        "hex": F.lit(KINDS.index("ip")),
        "quad": F.lit(KINDS.index("ip")),
        "digits": F.when(_is_card(m["hit"], n), KINDS.index("card")).otherwise(KINDS.index("phone")),
    }[name]
    features = F.struct(*[c.cast("int").alias(k) for k, c in _features(name, m).items()])
    return F.struct(
        kind.alias("kind"), m["start"].alias("start"), m["stop"].alias("stop"), features.alias("x"), holds.alias("holds")
    )


def _candidates(name: str) -> Column:
    """A generator's matches that are no base spans; ``holds`` only for a valid IPv6 address."""
    loose = F.filter(name, lambda m: ~_strict(name, m["hit"], F.length(_digits(m["hit"]))))
    return F.transform(loose, lambda m: _shaped(name, m, _ipv6(m["hit"]) if name == "hex" else F.lit(False)))


def _disguised(kind: str, m: Column) -> tuple[str, Column]:
    """(generator, a base span's text as people disguise such data), one way of some for each span, by hash."""
    hit = m["hit"]
    way = lambda n: F.pmod(F.xxhash64(hit, m["start"]), F.lit(n)).cast("int")
    if kind == "email":
        name, host = F.substring_index(hit, "@", 1), F.substring_index(hit, "@", -1)
        ats = F.array(*[F.lit(x) for x in (" (at) ", "[at]", " at ", " @ ", "(at)", " at ", " [at] ")])
        dots = F.array(*[F.lit(x) for x in (".", "[dot]", " dot ", ".", "(dot)", ".", " dot ")])
        return "mail", F.concat(name, F.get(ats, way(7)), F.replace(host, F.lit("."), F.get(dots, way(7))))
    if kind == "ip":
        dots = F.array(*[F.lit(x) for x in ("[.]", "(.)", " dot ", "[dot]", " . ")])
        return "quad", F.replace(hit, F.lit("."), F.get(dots, way(5)))
    if kind == "card":
        between = F.array(*[F.lit(x) for x in (".", "/", ". ", "--", "  ")])
        return "digits", F.regexp_replace(_digits(hit), F.lit("([0-9]{4})(?=[0-9])"), F.concat(F.lit("$1"), F.get(between, way(5))))
    plain = F.substring(hit, 2, 40)
    gap = F.lit("[^0-9]+")
    return "digits", (
        F.when(way(5) == 0, plain).when(way(5) == 1, F.concat(F.lit("00"), plain))
        .when(way(5) == 2, F.regexp_replace(plain, gap, F.lit(".")))
        .when(way(5) == 3, F.regexp_replace(plain, gap, F.lit("/")))
        .otherwise(F.regexp_replace(plain, gap, F.lit(" ")))
    )


def _planted(kind: str) -> Column:
    """The kind's base spans in disguise, each in its own context, as candidates that hold."""
    loose = {"mail": LOOSE_MAIL, "digits": LOOSE_DIGITS, "quad": LOOSE_QUAD}

    def disguised(m: Column) -> Column:
        text = _disguised(kind, m)[1]
        return F.struct(m["start"].alias("start"), m["stop"].alias("stop"), text.alias("hit"), m["before"], m["after"])

    name = {"email": "mail", "ip": "quad"}.get(kind, "digits")
    spans_ = F.transform(F.filter(kind, lambda m: _valid(kind, m["hit"])), disguised)
    met = F.filter(spans_, lambda m: m["hit"].rlike(f"^(?:{loose[name]})$"))
    return F.transform(met, lambda m: _shaped(name, m, F.lit(True)))


def _meets(a: Column, b: Column) -> Column:
    return (a["start"] < b["stop"]) & (b["start"] < a["stop"])


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = PRECISION) -> DataFrame:
    """(id, base, added) of every row: arrays of (kind, start, stop); kind is a place in KINDS."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.pmod(F.xxhash64(text), F.lit(2)).cast("int").alias("half"),
        text.alias("text"),
    )
    found = matches(rows, _triggers(F.col("text")), "text")
    found = found.select(
        "id",
        "half",
        F.monotonically_increasing_id().alias("row"),
        F.concat(*[_base(k) for k in KINDS]).alias("base"),
        F.concat(*[_candidates(n) for n in GENERATORS]).alias("candidates"),
        F.concat(*[_planted(k) for k in KINDS]).alias("planted"),
    )
    found = written(found, "pii-candidates")

    seen = found.select("half", F.explode(F.concat("candidates", "planted")).alias("c"))
    counted = seen.groupBy("c.kind", "c.x", "c.holds", "half")
    # one row a combination of feature values: bounded by their ranges
    table = counted.agg(F.count("*").alias("n")).collect()
    models = [_model(table, kind, precision) for kind in range(len(KINDS))]

    def chance(c: Column) -> Column:
        features = [c["x"][f] for f in FEATURES]
        of_kind = [boosting.as_column(m, features) for m, _ in models]
        least = [F.lit(float(t)) for _, t in models]
        p = F.lit(0.0)
        for kind in range(len(KINDS)):
            p = F.when(c["kind"] == kind, F.when(of_kind[kind] >= least[kind], of_kind[kind])).otherwise(p)
        return p

    scored = F.transform(
        "candidates",
        lambda c: F.struct(chance(c).alias("p"), c["kind"].alias("kind"), c["start"].alias("start"), c["stop"].alias("stop")),
    )
    likely = found.select("row", "base", F.filter(scored, lambda c: c["p"].isNotNull() & (c["p"] > 0)).alias("likely"))
    added = _apart(likely.filter(F.size("likely") > 0))
    none = F.array().cast("array<struct<kind:int,start:int,stop:int>>")
    return found.select("row", "id", "base").join(added, "row", "left").select(
        "id", "base", F.coalesce("added", none).alias("added")
    )


def _apart(likely: DataFrame) -> DataFrame:
    """(row, added): the candidates of each row (row, base, likely) that meet no base span and no better candidate."""
    found = likely.select("row", F.explode("likely").alias("c")).select("row", "c.*")
    base = likely.select("row", F.explode("base").alias("b")).select("row", "b.start", "b.stop")
    # base spans at their starts and candidates at their ends, in order: a candidate meets a base span
    # if one that starts before its end ends after its start
    empty = F.lit(None).cast("int")
    events = found.select("row", F.col("stop").alias("at"), F.lit(0).alias("turn"), "p", "kind", "start", "stop", empty.alias("reach"))
    events = events.union(
        base.select("row", "start", F.lit(1), F.lit(None).cast("double"), empty, empty, empty, F.col("stop"))
    )
    so_far = Window.partitionBy("row").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    free = events.withColumn("reach", F.max("reach").over(so_far)).filter("turn = 0 and coalesce(reach, 0) <= start")
    # candidates that meet in a row form an island; they are compared inside it
    order = Window.partitionBy("row").orderBy("start", "stop", "kind")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("start") >= before), 1).otherwise(0)
    islands = free.withColumn("opens", opens).withColumn("island", F.sum("opens").over(order))
    members = islands.groupBy("row", "island").agg(F.collect_list(F.struct("p", "kind", "start", "stop")).alias("c"))
    rank = lambda c: F.struct(c["p"], -c["start"], -c["kind"], c["stop"])
    best = F.filter("c", lambda c: ~F.exists("c", lambda d: _meets(d, c) & (rank(d) > rank(c))))
    kept = members.select("row", F.explode(best).alias("c"))
    span = F.struct(F.col("c.kind").alias("kind"), F.col("c.start").alias("start"), F.col("c.stop").alias("stop"))
    return kept.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("added"))


def _model(table: list, kind: int, precision: float) -> tuple:
    """(model, threshold) of a kind from the counts of both halves."""
    halves: list[dict] = [{}, {}]
    for r in table:
        if r["kind"] == kind:
            cell = halves[r["half"]].setdefault(tuple(r["x"][f] for f in FEATURES), [0.0, 0.0])
            cell[0 if r["holds"] else 1] += r["n"]
    model = boosting.fit({x: tuple(c) for x, c in sorted(halves[0].items())})
    return model, boosting.threshold(model, {x: tuple(c) for x, c in halves[1].items()}, precision)


def count_of(kind: str) -> Column:
    """Number of base spans of a kind."""
    number = KINDS.index(kind)
    return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")


def listed(spans_: Column) -> Column:
    """kind:start:end of an array of spans by kind, then start, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans_),
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )
