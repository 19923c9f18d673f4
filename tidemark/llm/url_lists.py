"""URL filters whose lists change over time, applied as they were at fetch time.

Dated entries of a pattern become intervals of validity; an as-of join gives each capture
the entries that were active when it was fetched, and the most specific one decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType
from pyspark.sql.window import Window

from tidemark.session import new_work_path, written

#: Later than any date.
OPEN = "9999-12-31"


_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*://"
_USER = "(?:[^/?#@]*@)?"
#: A host: an address in brackets, or all up to a port.
_HOST = r"(\[[^\]/?#]*\]|[^/?#:@\[\]]+)"
#: Labels of the longest name that the domain name system has.
LABELS = 127


def normal(pattern: Column) -> Column:
    """A listed pattern as ``patterns_of`` gives it: no scheme, user, port, fragment or
    slash at the end, the host in lower case. Null without a host."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(pattern), _SCHEME + _USER, ""), "#.*$", "")
    host = F.lower(F.regexp_extract(bare, "^" + _HOST, 1))
    rest = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*(.*)$", 1), "/+$", "")
    return F.when(F.length(host) > 0, F.concat(host, rest))


def intervals(entries: DataFrame, pattern: str = "pattern", action: str = "action", on: str = "listed_on") -> DataFrame:
    """``pattern, action, valid_from, valid_to`` (exclusive) from dated entries.

    An entry holds from its instant (of a date, midnight) until the next one of its
    pattern; action ``remove`` ends one. Of entries of one instant the alphabetically last
    action counts. Patterns are those of ``normal``. Entries without pattern, time or
    action are left out. Repeats of an action make intervals that follow each other.
    """
    dated = (
        entries.select(
            normal(F.col(pattern)).alias("pattern"),
            F.col(action).alias("action"),
            F.col(on).cast("timestamp").alias("valid_from"),
        )
        .where("pattern IS NOT NULL AND action IS NOT NULL AND valid_from IS NOT NULL")
        .groupBy("pattern", "valid_from")
        .agg(F.max("action").alias("action"))
    )
    after = F.lead("valid_from").over(Window.partitionBy("pattern").orderBy("valid_from"))
    return (
        dated.withColumn("valid_to", F.coalesce(after, F.lit(OPEN).cast("timestamp")))
        .where("action <> 'remove'")
        .select("pattern", "action", "valid_from", "valid_to")
    )


def patterns_of(
    url: Column, depth: int | None = None, longest: Column | None = None, parts: Column | None = None
) -> Column:
    """The patterns that can name a URL, most specific first: host with path and query, host
    with each prefix of the path's parts (with ``depth``, only those of so few parts and no
    query), host, and each parent domain of at least two and at most ``LABELS`` labels. An
    address in brackets has no parent. Null without a host.

    ``longest`` and ``parts`` leave out what has more characters or parts after the host, so
    that a long URL makes no more patterns than a list can hold.
    """
    host = F.lower(F.regexp_extract(url, _SCHEME + _USER + _HOST, 1))
    path = F.regexp_extract(url, _SCHEME + "[^/?#]+/([^?#]*)", 1)
    # With one character more, the last part of a path that is cut off is too long.
    whole = F.lit(True) if longest is None else F.length(path) <= longest
    held = F.split(path if longest is None else F.substring(path, F.lit(1), longest + 1), "/")
    held = F.when(whole, held).otherwise(F.slice(held, F.lit(1), F.size(held) - 1))
    labels = F.when(F.startswith(host, F.lit("[")), F.array(host)).otherwise(F.split(host, "\\."))
    parents = F.sequence(F.greatest(F.lit(2), F.size(labels) - LABELS + 1), F.size(labels) - 1)
    domains = F.transform(
        F.when(F.size(labels) > 2, parents).otherwise(F.array().cast("array<int>")),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    most = F.size(held) if depth is None else F.least(F.size(held), F.lit(depth))
    most = most if parts is None else F.least(most, parts)
    prefixes = F.transform(
        F.when(most > 0, F.reverse(F.sequence(F.lit(1), F.greatest(most, F.lit(1))))).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(held, F.lit(1), i), "/")),
    )
    inner = F.filter(prefixes, lambda p: ~p.endswith("/"))
    if depth is None:
        query = F.regexp_replace(F.regexp_extract(url, _SCHEME + "[^/?#]+([^?#]*[?][^#]*)", 1), "/+$", "")
        asked = F.length(query) > 0
        asked = asked if longest is None else asked & (F.length(query) <= longest)
        inner = F.concat(F.when(asked, F.array(F.concat(host, query))).otherwise(F.array().cast("array<string>")), inner)
    return F.when(F.length(host) > 0, F.concat(inner, F.array(host), domains))


def filter_captures(
    captures: DataFrame,
    entries: DataFrame,
    id_: str = "page_id",
    url: str = "url",
    fetched: str = "fetched_on",
) -> DataFrame:
    """A row for each capture: id, fetch time, ``verdict`` and the ``pattern`` behind it.

    The verdict is the action of the most specific entry that was active at the fetch
    time, or ``none``; a date is its midnight and stays a date. A URL that is null or has
    no host, and a fetch time that is null, have no verdict but ``none``. Equal captures are looked up once and returned as often
    as they come. Empty tables give no rows, or only ``none``. Extra columns are not read.

    A host may hold a third of all captures: the join is an equality of patterns whose
    large partitions Spark splits, and its other side has the few intervals of a pattern.
    URLs of any length are looked up by no more and no longer patterns than the list has.
    """
    # Written: it is measured, then joined.
    spans = written(intervals(entries), new_work_path(captures.sparkSession, "intervals"))
    rest = F.length("pattern") - F.length(F.regexp_extract("pattern", "^[^/?]*", 0))
    parts = F.size(F.split("pattern", "/")) - 1
    longest, deepest = (F.lit(n or 0) for n in spans.agg(F.max(rest), F.max(parts)).first())
    day = captures.schema[fetched].dataType == DateType()
    wanted = (
        captures.select(F.col(id_).alias("id"), F.col(url).alias("url"), F.col(fetched).cast("timestamp").alias("fetched"))
        .groupBy("id", "url", "fetched")
        .agg(F.count("*").alias("rows"))
    )
    looked_up = wanted.select("id", "url", "fetched", F.posexplode(patterns_of(F.col("url"), longest=longest, parts=deepest)).alias("place", "key"))
    active = (
        looked_up.join(
            spans,
            (F.col("key") == F.col("pattern"))
            & (F.col("fetched") >= F.col("valid_from"))
            & (F.col("fetched") < F.col("valid_to")),
        )
        .groupBy("id", "url", "fetched")
        .agg(F.min(F.struct("place", "action", "pattern")).alias("best"))
        .select(F.col("id").alias("i"), F.col("url").alias("u"), F.col("fetched").alias("f"), "best.action", "best.pattern")
    )
    same = (
        F.col("id").eqNullSafe(F.col("i")) & F.col("url").eqNullSafe(F.col("u")) & F.col("fetched").eqNullSafe(F.col("f"))
    )
    return (
        wanted.join(active, same, "left")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
        .select(
            F.col("id").alias(id_), F.col("fetched").cast("date" if day else "timestamp").alias(fetched),
            F.coalesce("action", F.lit("none")).alias("verdict"), "pattern",
        )
    )
