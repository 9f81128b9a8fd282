"""Personal data: generators of candidates, boosted trees, thresholds.

The generators are patterns. Those of the four base kinds find spans that a
check (digits, Luhn, octets) confirms or not; wider ones propose whatever
looks like an address or a number, written out, without its sign or with
other marks, overlapping the others. Confirmed spans are always redacted.

They are also all that is known to be personal data: the candidates apart
from them are unlabelled, some of them positive. Boosted trees learn from
both which candidates are confirmed ones, by format and context only; what
sets the wide patterns apart (signs, marks, spelling) is no feature. A
positive is confirmed with a probability that does not depend on its
features (c, the mean of the trees' answers on the confirmed spans of its
kind), so the probability that a candidate is positive is the trees' answer
over c (Elkan and Noto 2008). Candidates of the wide patterns are redacted
from the threshold of their kind on: the smallest one at which the expected
precision of all unlabelled candidates above it is ``PRECISION`` or more.
Candidates of equal probability stand or fall together.

Candidates are counted per combination of feature values (cells). The cells
are few, whatever the number of documents, and the trees are fitted on them;
the fitted trees are an expression. All rows take DataFrame functions only.

Offsets are code points. A pattern's matches and the pieces between them
(regexp_extract_all, split) give them by a running sum.

Defined results: null or empty text has no spans; overlapping patterns may
give overlapping spans; each row gets its result; only doc_id and text are
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlens.llm.boosting import Boosted, Cell
from plantlens.llm.common import written

PRECISION = 0.9
KINDS = ("email", "ip", "card", "phone")

# The base patterns. Possessive repeats and looks behind only
# spare the engine useless starts; they find the same spans.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider patterns, with the kind that each proposes.
# Wider patterns, with the kind that each proposes.
AT, DOT = r"(?:\x20?(?:\(at\)|\[at\])\x20?|\x20@\x20|@)", r"(?:\x20?(?:\(dot\)|\[dot\])\x20?|\x20\.\x20|\.)"
NAME, HOST = r"(?i)(?<![A-Z0-9._%+-])[A-Z0-9._%+-]++", r"[A-Z0-9-]++"
WIDE = {
    "spelled": ("email", rf"{NAME}{AT}{HOST}(?:{DOT}{HOST})++"),
    "spoken": ("email", rf"{NAME}\x20at\x20{HOST}(?:\x20dot\x20{HOST})++"),
    "dotted": ("ip", r"(?<![0-9.])[0-9]{1,3}(?:(?:[.:,-]|\[\.\]|\x20?[\[(]dot[\])]\x20?)[0-9]{1,3}){3}(?![0-9.])"),
    "digits": ("card", r"(?<![0-9])[0-9](?:[\x20._/-]{0,2}[0-9]){12,}+"),
    "number": ("phone", r"(?<![0-9+])\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+"),
}
CANDIDATES = r"(?i)[0-9@]|[(\[](?:at|dot)[)\]]|\x20dot\x20"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])){3}$"
CUES = (
    r"(?i)phone|tel|call|fax|mobile|contact",
    r"(?i)card|visa|credit|account|iban",
    r"(?i)mail|write",
    r"(?i)\bip\b|address|host|server|login",
    r"(?i)token|key|secret|password|hash|id\b",
)
FEATURES = ("kind", "check", "shape", "before", "after", "cue")
AROUND = 24


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    from_right = F.split(F.reverse(digits), "")
    doubled = F.transform(
        F.filter(from_right, lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, x: total + x) % 10 == 0


def confirmed(kind: str, match: Column) -> Column:
    """The check of a base kind."""
    size = F.length(_digits(match))
    if kind == "ip":
        return match.rlike(OCTETS)
    if kind == "card":
        return F.when((size >= 16) & (size <= 19), luhn(_digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return (size >= 8) & (size <= 15)
    return F.lit(True)


def _hits(number: int) -> Column:
    """Matches of a pattern, with the code points before each since the
    last one and the characters around it. Columns m and p with its number
    hold the matches and the pieces between them."""
    pieces = f"p{number}"
    return F.transform(
        f"m{number}",
        lambda m, i: F.struct(
            F.lit(number).alias("pattern"), i.alias("at"), F.length(F.get(pieces, i)).alias("gap"), m.alias("match"),
            F.right(F.get(pieces, i), F.lit(AROUND)).alias("before"),
            F.left(F.get(pieces, i + 1), F.lit(1)).alias("after"),
        ),
    )


def hits(documents: DataFrame) -> DataFrame:
    """Per document: row, doc_id and the matches of all patterns."""
    text = F.coalesce("text", F.lit(""))
    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.when(text.rlike(CANDIDATES), text).alias("text")
    )
    patterns = [*BASE.values(), *(p for _, p in WIDE.values())]
    cut = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        *(F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"m{k}") for k, p in enumerate(patterns)),
        *(F.split("text", p, -1).alias(f"p{k}") for k, p in enumerate(patterns)),
    )
    return cut.select("row", "doc_id", F.concat(*(_hits(k) for k in range(len(patterns)))).alias("hits"))


def plain(kind: str, match: Column) -> Column:
    """A candidate written as the base pattern of its kind has it."""
    if kind == "email":
        at = F.regexp_replace(match, r"(?i)\x20?[(\[]at[)\]]\x20?|\x20@\x20|\x20at\x20", "@")
        return F.regexp_replace(at, r"(?i)\x20?[(\[]dot[)\]]\x20?|\x20\.\x20|\x20dot\x20", ".")
    if kind == "ip":
        return F.regexp_replace(match, r"(?i)\[\.\]|\x20?[(\[]dot[)\]]\x20?", ".")
    return match


def shape(kind: str, match: Column) -> Column:
    """Format of a plain candidate, a small number. Emails: letters of the
    last part (0 to 7, 8 if others occur). Else its groups of digits: 0 one,
    1 all of four, 2 like a date, 3 none above four, 4 other."""
    if kind == "email":
        last = F.element_at(F.split(match, r"\."), -1)
        return F.when(last.rlike("^[A-Za-z]+$"), F.least(F.length(last), F.lit(7))).otherwise(8)
    sizes = F.transform(F.filter(F.split(match, "[^0-9]+"), lambda g: g != ""), F.length)
    three = F.array_sort(sizes) == F.array(F.lit(2), F.lit(2), F.lit(4))
    return (
        F.when(F.size(sizes) == 1, 0).when(F.forall(sizes, lambda n: n == 4), 1).when(three, 2)
        .when(F.forall(sizes, lambda n: n <= 4), 3).otherwise(4)
    )


def spans(found: DataFrame) -> DataFrame:
    """One row per match: its kind (number), code points [start, stop),
    whether it is a confirmed base span or one of a wide pattern, and the
    features."""
    flat = found.select("row", F.inline("hits"))
    order = Window.partitionBy("row", "pattern").orderBy("at")
    size = F.length("match")
    flat = flat.withColumn("stop", F.sum(F.col("gap") + size).over(order)).withColumn("start", F.col("stop") - size)
    names = list(KINDS)
    kinds = [names.index(k) for k in (*BASE, *(k for k, _ in WIDE.values()))]
    flat = flat.withColumn("kind", F.get(F.array(*(F.lit(k) for k in kinds)), F.col("pattern")))

    def by_kind(value):
        column = F.lit(None)
        for k, kind in enumerate(names):
            column = F.when(F.col("kind") == k, value(kind)).otherwise(column)
        return column

    flat = flat.withColumn("plain", by_kind(lambda kind: plain(kind, F.col("match"))))
    wide = F.col("pattern") >= len(BASE)
    # A check takes what the base pattern of its kind could have found.
    found_so = {"email": r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$", "ip": "^[0-9.]+$"}
    check = by_kind(lambda kind: F.col("plain").rlike(found_so.get(kind, "")) & confirmed(kind, F.col("plain")))
    cue = F.lit(len(CUES))
    for k, pattern in reversed(list(enumerate(CUES))):
        cue = F.when(F.col("before").rlike(pattern), k).otherwise(cue)
    return flat.withColumn("checked", F.coalesce(check, F.lit(False))).select(
        "row", "start", "stop", "kind", wide.alias("wide"), (~wide & F.col("checked")).alias("sure"),
        F.col("checked").cast("int").alias("check"),
        by_kind(lambda kind: shape(kind, F.col("plain"))).cast("int").alias("shape"),
        _class(F.right("before", F.lit(1))).alias("before"),
        _class(F.col("after")).alias("after"),
        cue.cast("int").alias("cue"),
    )


def _class(character: Column) -> Column:
    """0 nothing, 1 blank, 2 letter, 3 point or comma, 4 quote or =, 5 +,
    6 other."""
    kinds = ((r"^\s", 1), (r"^\p{L}", 2), (r"^[.,;:]", 3), (r"^[\"'=]", 4), (r"^[+(]", 5))
    found = F.when(character == "", 0).otherwise(6)
    for pattern, number in reversed(kinds):
        found = F.when(character.rlike(pattern), number).otherwise(found)
    return F.coalesce(found, F.lit(0)).cast("int")


def _overlaps(*group: str) -> Column:
    """Whether a confirmed span of the group overlaps. One that starts no
    later overlaps if its end lies beyond the start, one that starts no
    earlier if its start lies before the end."""
    place = Window.partitionBy(*group).orderBy("start")
    before = place.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = place.rangeBetween(Window.currentRow, Window.unboundedFollowing)
    furthest = F.max(F.when(F.col("sure"), F.col("stop"))).over(before)
    nearest = F.min(F.when(F.col("sure"), F.col("start"))).over(after)
    return F.coalesce(furthest > F.col("start"), F.lit(False)) | F.coalesce(nearest < F.col("stop"), F.lit(False))


def labelled(every: DataFrame) -> DataFrame:
    """The spans with ``covered``: whether they overlap a confirmed span."""
    return every.withColumn("covered", _overlaps("row"))


def fit(candidates: DataFrame, precision: float = PRECISION) -> tuple[Boosted | None, dict[int, float]]:
    """The trees, and for each kind the least answer of the trees that a
    redacted candidate has. A kind without confirmed spans has none."""
    counted = candidates.where("sure or not covered").groupBy(*FEATURES).agg(
        F.count("*").alias("rows"), F.count_if("sure").alias("positive")
    )
    cells = [Cell(tuple(r[f] for f in FEATURES), r["rows"], r["positive"]) for r in counted.orderBy(*FEATURES).collect()]
    if not any(c.positive for c in cells):
        return None, {}
    model = Boosted.fit(cells)
    limits = {}
    for kind in range(len(KINDS)):
        own = [(round(model.probability(c.values), 9), c) for c in cells if c.values[0] == kind]
        known = sum(c.positive for _, c in own)
        if not known:
            continue
        share = sum(p * c.positive for p, c in own) / known
        rows = expected = 0.0
        for answer in sorted({p for p, _ in own}, reverse=True):
            unlabelled = sum(c.rows - c.positive for p, c in own if p == answer)
            rows += unlabelled
            expected += unlabelled * min(1.0, answer / share)
            if rows and expected >= precision * rows:
                limits[kind] = answer
    return model, limits


def _list(found: Column) -> Column:
    """kind:start:end of spans (number of the kind, start, stop), in order."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(
            F.array_sort(found),
            lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )


def personal_data(documents: DataFrame, precision: float = PRECISION) -> DataFrame:
    """Per document: doc_id, found (spans as structs of kind number k,
    start, stop, and whether base), and the base and full span lists."""
    found = written(hits(documents), "pii-hits")
    candidates = written(labelled(spans(found)), "pii-candidates")
    model, limits = fit(candidates, precision)
    likely = F.lit(False)
    if model:
        answer = F.round(model.column([F.col(f) for f in FEATURES]), 9)
        limit = F.lit(2.0)
        for kind, value in limits.items():
            # Half a unit of the last place: equal answers stay together.
            limit = F.when(F.col("kind") == kind, value - 5e-10).otherwise(limit)
        likely = F.col("wide") & ~F.col("covered") & (answer >= limit)
    span = F.struct(
        F.col("kind").alias("k"), F.col("start").cast("bigint").alias("start"), F.col("stop").cast("bigint").alias("stop")
    )
    chosen = candidates.where(F.col("sure") | likely).select("row", "kind", "sure", span.alias("span"))
    empty = F.array().cast("array<struct<k: int, start: bigint, stop: bigint>>")
    per_doc = chosen.groupBy("row").agg(
        F.collect_list(F.when(F.col("sure"), F.col("span"))).alias("base"),
        F.collect_set("span").alias("spans"),
        *(F.count(F.when(F.col("sure") & (F.col("kind") == k), 1)).alias(f"n_{name}") for k, name in enumerate(KINDS)),
    )
    return found.select("row", "doc_id").join(per_doc, "row", "left").select(
        "doc_id",
        *(F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS),
        F.coalesce("base", empty).alias("base"),
        F.coalesce("spans", empty).alias("spans"),
    )


def digest(found: DataFrame) -> DataFrame:
    """The query's columns of ``personal_data``."""
    return found.select(
        "doc_id", *(f"n_{k}" for k in KINDS), F.sha2(_list(F.col("base")), 256).alias("base_sha256"),
        _list(F.col("spans")).alias("spans"),
    )


def redact(documents: DataFrame, precision: float = PRECISION) -> DataFrame:
    """``documents`` of distinct ids with every span replaced by its kind in
    brackets; overlapping spans become one, named by its first kind."""
    found = personal_data(documents, precision).where("size(spans) > 0").select(
        F.col("doc_id").alias("_id"),
        F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["k"].alias("k")))).alias("_spans"),
    )
    joined = documents.join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    text = F.expr(f"""
        aggregate(_spans, named_struct('done', '', 'upto', 0L), (a, s) -> if(s.start < a.upto,
            named_struct('done', a.done, 'upto', greatest(a.upto, s.stop)),
            named_struct('done', concat(a.done, substring(text, int(a.upto) + 1, int(s.start - a.upto)),
                                        '[', get({names}, s.k), ']'), 'upto', s.stop)),
        a -> concat(a.done, substring(text, int(a.upto) + 1)))""")
    columns = [F.coalesce(text, "text").alias("text") if c == "text" else F.col(c) for c in documents.columns]
    return joined.select(*columns)
