"""Operator 6: secret scan with multipart credential linking, in DataFrame functions only.

Every kind of part is located by its pattern: the pieces between matches and the
matches themselves give the offsets.  Kinds that are secrets on their own (base:
assign, access, hex) are always reported.  Weak parts (a short access identifier,
a bare value that looks random, an endpoint) are reported only if complementary
parts co-occur: parts are sorted by place in their document, each part's interval
is widened by the scope, and running maxima and minima of the other roles'
bounds tell whether another role's interval is met.  That is an interval join by
sweep: no pairs are made, whatever a document holds.

Defined results: a null text is the empty text, which has no spans.  Offsets are
code points, ends exclusive.  Spans are sorted by start, then by kind as listed
in KINDS.  Every row is handled by itself, also rows with equal or null ids; an
empty table gives an empty table.  Very long texts and runs of characters are
handled whole: no pattern has an upper bound or a group that repeats.  Added
columns replace input columns of the same names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    """name; pattern; role in a credential; whether it is reported without complementary parts."""

    name: str
    pattern: str
    role: str
    base: bool


LEAD = "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?"
VALUE = "[A-Za-z0-9+/_.=-]+"

#: In report order.  The base kinds are the contract's; where a run of characters
#: has one longest match, its least length stands in the pattern.
KINDS = [
    Kind("assign", LEAD + VALUE, "secret", True),
    Kind("access", "AKIA[A-Z0-9]{14,}", "id", True),
    Kind("hex", "[0-9a-f]{16,}", "secret", True),
    Kind("weak_id", "\\b(?:AKIA|ASIA|AROA|AIDA)[A-Z0-9]{6,}+\\b", "id", False),
    Kind("weak_user", "\\b(?:user(?:name)?|login|client_?id|account)[\"']?\\x20*+[:=]\\x20*+[\"']?[A-Za-z0-9_.@-]{3,}+", "id", False),
    Kind("weak_secret", "(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9a-z+/_-]*+[A-Z])(?=[0-9A-Z+/_-]*+[a-z])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])", "secret", False),
    Kind("endpoint", "\\b(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|ftp|ssh)://[A-Za-z0-9._~:/@%?=&+-]{4,}+", "endpoint", False),
    # one run of characters, no repeated group: the matcher's stack must not grow with the text
    Kind("weak_host", "\\b(?:host|hostname|server|endpoint)[\"']?\\x20*+[:=]\\x20*+[\"']?(?=[A-Za-z0-9-]++\\.[A-Za-z0-9-])[A-Za-z0-9.-]*[A-Za-z0-9-](?::[0-9]{2,}+)?", "endpoint", False),
]

#: Least characters of an assigned value that counts.
LEAST_VALUE = 12
#: Characters that may lie between linked parts.
SCOPE = 160

_MATCH = "array<struct<order:int,nth:int,gap:int,size:int,ok:boolean>>"


def _matches(text: Column, order: int) -> Column:
    """One kind's matches: order, number, characters since the last match, size, whether it counts."""
    kind = KINDS[order]

    def one(gap: Column, m: Column) -> Column:
        ok = F.length(F.regexp_replace(m, "^" + LEAD, "")) >= LEAST_VALUE if kind.name == "assign" else F.lit(True)
        return F.struct(F.length(gap).alias("gap"), F.length(m).alias("size"), ok.alias("ok"))

    both = F.zip_with(F.split(text, kind.pattern, -1), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), one)
    full = F.filter(both, lambda x: x["size"].isNotNull())
    rows = F.transform(full, lambda x, i: F.struct(F.lit(order).alias("order"), i.alias("nth"), x["gap"].alias("gap"), x["size"].alias("size"), x["ok"].alias("ok")))
    return F.when(text.rlike(kind.pattern), rows).otherwise(F.expr(f"cast(array() as {_MATCH})"))


def scan(df: DataFrame, text: str = "text", keep: list[str] | None = None, scope: int = SCOPE) -> DataFrame:
    """Adds spans: array<struct<start,order,end,kind>> of the reported parts, sorted.

    Each row gets a number that is unique in the run, so that parts meet again
    with their row after the sweep; kept columns are shuffled once, with the
    row's first part.
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c != "spans"]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(
        F.monotonically_increasing_id().alias("__row"),
        F.struct(F.lit(1).alias("__"), *[F.col(f"`{c}`") for c in keep]).alias("__kept"),
        F.concat(*[_matches(body, i) for i in range(len(KINDS))]).alias("__m"),
    )
    parts = rows.select("__row", "__kept", F.posexplode_outer("__m").alias("__i", "__p"))
    parts = parts.select("__row", F.when(F.coalesce("__i", F.lit(0)) == 0, F.col("__kept")).alias("__kept"), "__p.*").repartition("__row")
    before = F.sum(F.col("gap") + F.col("size")).over(W.partitionBy("__row", "order").orderBy("nth"))
    role = F.element_at(F.array(*[F.lit(k.role) for k in KINDS]), F.col("order") + 1)
    name = F.element_at(F.array(*[F.lit(k.name) for k in KINDS]), F.col("order") + 1)
    base = F.element_at(F.array(*[F.lit(k.base) for k in KINDS]), F.col("order") + 1)
    placed = parts.withColumn("end", before.cast("int")).withColumn("start", F.col("end") - F.col("size"))
    placed = placed.select("__row", "__kept", "start", "order", "end", F.when(F.col("ok"), role).alias("role"), base.alias("base"), name.alias("kind"))
    span = F.struct("start", "order", "end", "kind")
    linked = reported(placed, "__row", scope)
    gathered = linked.groupBy("__row").agg(F.first("__kept", ignorenulls=True).alias("__kept"), F.array_sort(F.collect_list(F.when(F.col("__report"), span))).alias("spans"))
    return gathered.select(*[F.col(f"__kept.`{c}`").alias(c) for c in keep], "spans")


def reported(parts: DataFrame, row: str, scope: int) -> DataFrame:
    """Adds __report: base parts, and weak parts whose widened interval meets one of a complementary role.

    Parts of no role don't count.  A weak part that overlaps a base part is
    dropped.  An identifier or a secret needs the other of the two within the
    scope, an endpoint needs both.
    """
    by = W.partitionBy(row).orderBy("start", "order")
    ahead, after = by.rowsBetween(W.unboundedPreceding, -1), by.rowsBetween(1, W.unboundedFollowing)

    def nearest(which: Column) -> tuple[Column, Column]:
        return F.max(F.when(which, F.col("end"))).over(ahead), F.min(F.when(which, F.col("start"))).over(after)

    yes = lambda c: F.coalesce(c, F.lit(False))
    end, start = nearest(F.col("base") & F.col("role").isNotNull())
    covered = ~yes(F.col("base")) & (yes(end > F.col("start")) | yes(start < F.col("end")))
    parts = parts.withColumn("role", F.when(~covered, F.col("role")))

    def met(role: str) -> Column:
        end, start = nearest(F.col("role") == role)
        return yes(end + scope >= F.col("start")) | yes(start - scope <= F.col("end"))

    complementary = F.when(F.col("role") == "id", met("secret")).when(F.col("role") == "secret", met("id")).otherwise(met("id") & met("secret"))
    return parts.withColumn("__report", yes(F.col("role").isNotNull() & (F.col("base") | complementary)))


def redact(df: DataFrame, text: str = "text", spans: str = "spans", mark: str = "[secret]") -> DataFrame:
    """Replaces each reported span (overlapping spans as one) by the mark; texts without spans stay as they are.

    Spans are taken in groups of about the square root of their number.  A group needs
    the furthest end before it and its own part of the text only, so neither the
    text nor the spans are gone through once for every span.
    """
    body, found = F.col(f"`{text}`"), F.col(f"`{spans}`")
    size = F.ceil(F.sqrt(F.size(found))).cast("int")
    furthest = lambda part: F.coalesce(F.array_max(F.transform(part, lambda s: s["end"])), F.lit(0))

    def group(nth: Column) -> Column:
        """The group's part of the text, after its marks are set."""
        own = F.slice(found, nth * size + 1, size)
        begin = furthest(F.slice(found, F.lit(1), nth * size))
        known = F.array(F.struct(own.alias("spans"), begin.alias("begin"), F.substring(body, begin + 1, F.greatest(furthest(own) - begin, F.lit(0))).alias("body")))
        return F.element_at(F.transform(known, replaced), 1)

    def replaced(g: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            at = F.greatest(g["begin"], furthest(F.slice(g["spans"], F.lit(1), i)))
            return F.when(s["start"] >= at, F.concat(F.substring(g["body"], at - g["begin"] + 1, s["start"] - at), F.lit(mark))).otherwise("")

        return F.array_join(F.transform(g["spans"], one), "")

    groups = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / size).cast("int"))
    done = F.concat(F.array_join(F.transform(groups, group), ""), F.substring(body, furthest(found) + 1, F.length(body)))
    return df.withColumn(text, F.when(F.size(found) > 0, done).otherwise(body))
