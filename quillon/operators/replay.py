"""Requests that change a store, applied one after another without going through them one after another.

What a request means depends on what earlier ones did: an update renames a
reminder that a later text then finds, a delete makes an ambiguous text clear.
The replay assumes which requests take effect, merges those changes field by
field (the last value that is not null, a delete as a tombstone) into versions
of reminders that hold between two changes, looks every request up among the
versions that hold when it comes, and repeats with what that gives until
nothing changes.  A repetition settles at least the first request that was not
settled, so the end is what the requests give one by one; the number of
repetitions is the length of the longest chain of requests each of which
changes what the next one means, not the number of requests.  Scopes do not
meet, so each repetition takes only the scopes that the last one changed, and a
request's moment is its number within its scope.

Nothing is grouped by store or conversation.  Texts are matched once, before the
first repetition, over all texts that any reminder ever has.  Versions that
never change are joined by their text alone.  Those that do are posted under the
blocks of a binary division of time that make up their life, and a request under
the blocks that hold its moment, so that a reminder with very many versions
meets each request once and not with all of them.  Merges over one reminder run
in ranges of ``RANGE`` moments, so a hot one does not meet in one task.

Every table here grows with the requests and most are exploded, which Spark's
estimates from file sizes leave out, so ``SHUFFLED`` keeps all joins from
being broadcast by the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.text import squeezed, time_matches
from quillon.operators.store import contained_pairs, numbered, task_pairs
from quillon.scratch import SHUFFLED, Scratch

RANGE_BITS = 12
FIELDS = ("task", "time_text", "scheduled_time")


def running(rows: DataFrame, keys: list[str], order: str, last: tuple[str, ...] = (), sums: tuple[str, ...] = (), bits: int | None = None) -> DataFrame:
    """``rows`` with each column of ``last`` as its last value up to the row that is not null, each of ``sums`` as its sum
    up to the row, and ``next``, the order of the following row.

    Done in ranges of ``2 ** bits`` of the order and over the ranges, so that no key meets in one window.
    """
    cut = F.shiftright(order, RANGE_BITS if bits is None else bits)
    per = rows.groupBy(*keys, cut.alias("_range")).agg(
        F.min(order).alias("_first"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_{c}") for c in last],
        *[F.sum(c).alias(f"_{c}") for c in sums],
    )
    ranges = Window.partitionBy(*keys).orderBy("_range")
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    carried = per.select(
        *keys, "_range", F.lead("_first").over(ranges).alias("_following"),
        *[F.last(f"_{c}", True).over(before).alias(f"_{c}") for c in last],
        *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in sums],
    )
    own = Window.partitionBy(*keys, "_range").orderBy(order)
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = rows.withColumn("_range", cut).select(
        *[c for c in rows.columns if c not in last + sums], "_range", F.lead(order).over(own).alias("_next"),
        *[F.last(c, True).over(upto).alias(c) for c in last], *[F.sum(c).over(upto).alias(c) for c in sums],
    )
    out = within.join(carried.hint(SHUFFLED), [*keys, "_range"])
    plain = [c for c in rows.columns if c not in last + sums]
    return out.select(*plain, F.coalesce("_next", "_following").alias("next"), *[F.coalesce(c, f"_{c}").alias(c) for c in last], *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in sums])


def _given(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def _said(c: str) -> Column:
    return F.when(_given(c), F.col(c))


def _judged(requests: DataFrame, reminders: DataFrame) -> DataFrame:
    """Requests with ``at`` (their number) and ``turn`` (that in their scope), ``lacks`` (what alone decides against them), ``unread`` (a new time that could
    not be read, which counts once a reminder is found) and ``made``, the id that a create makes."""
    tool = F.col("tool")
    absent = F.array_compact(F.array(*[F.when(~_given(c), F.lit(c)) for c in ("time_text", "task")]))
    create = F.when(F.size(absent) > 0, absent).when(F.col("time_iso").isNull(), F.array(F.lit("time_text")))
    nothing_new = (tool == "update") & ~_given("new_time_text") & ~_given("new_task")
    nowhere = ~_given("reminder_id") & ~_given("time_text") & ~_given("task")
    lacks = (
        F.when(tool == "create", create)
        .when(nothing_new, F.array(F.lit("new_time_text|new_task")))
        .when(nowhere & tool.isin("update", "delete"), F.array(F.lit("reminder_id|time_text|task")))
    )
    rows = numbered(requests, "request_id", "at").withColumn("lacks", lacks)
    rows = rows.withColumn("unread", (tool == "update") & _given("new_time_text") & F.col("new_time_iso").isNull())
    rows = rows.withColumn("all", nowhere & (tool == "query")).withColumn("makes", ((tool == "create") & F.col("lacks").isNull()).cast("long"))
    number = F.expr("try_cast(split_part(reminder_id, '_', 2) as int)")
    top = reminders.groupBy(F.col("scope").alias("top_scope")).agg(F.coalesce(F.max(number), F.lit(0)).alias("top"))
    counted = running(rows.select("scope", "at", "makes", F.lit(1).cast("long").alias("turn")), ["scope"], "at", sums=("makes", "turn")).select("at", F.col("makes").alias("nth"), "turn")
    rows = rows.join(counted.hint(SHUFFLED), "at").join(top.hint(SHUFFLED), F.col("scope") == F.col("top_scope"), "left")
    made = F.format_string("rem_%04d", F.coalesce("top", F.lit(0)) + F.col("nth"))
    return rows.withColumn("made", F.when(F.col("makes") > 0, made)).drop("makes", "nth", "top", "top_scope")


def _keys(asked: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """What requests are looked up under: ``at``, ``turn``, ``scope`` and ``key``, with ``by_task`` and the time that must match too.

    A request with a task has a key for each task that it means; one with a time
    alone has a key for each time text and one for its day.
    """
    fuzzy = asked.where("lacks is null and tool <> 'create' and not all").where(~_given("reminder_id")).select("at", "turn", "scope", _said("task").alias("q"), _said("time_text").alias("time_text"), "time_iso")
    fuzzy = scratch.save(fuzzy)
    pairs = task_pairs(fuzzy.select("q"), texts.select("task"))
    tasked = fuzzy.join(pairs.hint(SHUFFLED), "q").select("at", "turn", "scope", F.concat(F.lit("task:"), "t").alias("key"), F.lit(True).alias("by_task"), "time_text", "time_iso")
    timed = fuzzy.where("q is null")
    said, stored = timed.select(squeezed(F.col("time_text")).alias("x")), texts.select(squeezed(F.col("time_text")).alias("y"))
    near = contained_pairs(said, stored).toDF("x", "y").unionByName(contained_pairs(stored, said).toDF("y", "x")).distinct()
    plain = lambda df, key: df.select("at", "turn", "scope", key.alias("key"), F.lit(False).alias("by_task"), "time_text", "time_iso")
    by_text = plain(timed.join(near.hint(SHUFFLED), squeezed(F.col("time_text")) == F.col("x")), F.concat(F.lit("time:"), "y"))
    by_day = plain(timed.where("time_iso is not null"), F.concat(F.lit("day:"), F.substring("time_iso", 1, 10)))
    return scratch.save(tasked.unionByName(by_text).unionByName(by_day))


def _blocks(first: Column, end: Column, levels: int) -> Column:
    """The blocks of the binary division that make up the whole numbers from ``first`` to before ``end``: at most two a level."""

    def at(level: Column) -> Column:
        lo = F.ceil(first / F.pow(F.lit(2.0), level)).cast("long")
        hi = F.floor(end / F.pow(F.lit(2.0), level)).cast("long")
        block = lambda n: F.struct(level.alias("level"), n.alias("n"))
        return F.array_compact(F.array(F.when((lo < hi) & (lo % 2 == 1), block(lo)), F.when((lo < hi) & (hi % 2 == 1), block(hi - 1))))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at))


def _around(moment: Column, levels: int) -> Column:
    """The blocks that hold a moment, one a level."""
    return F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda v: F.struct(v.alias("level"), F.floor(moment / F.pow(F.lit(2.0), v)).cast("long").alias("n")))


class _Store:
    """The reminders there ever are, and their versions under assumed changes."""

    def __init__(self, base: DataFrame, asked: DataFrame, keys: DataFrame, levels: int, end: int):
        self.base, self.asked, self.keys, self.levels, self.end = base, asked, keys, levels, end

    def changes(self, hits: DataFrame) -> DataFrame:
        """Changes of ``hits`` (``at``, ``rid``) in the shape of ``base``; ``moment`` is odd, as a request is met at 2 * turn."""
        own = hits.drop("scope").join(self.asked.hint(SHUFFLED), "at")
        timed = lambda c: F.when(_given("new_time_text"), F.col(c))
        return own.select(
            "scope", "rid", (2 * F.col("turn") + 1).alias("moment"), F.when(F.col("tool") == "update", _said("new_task")).alias("task"),
            F.when(F.col("tool") == "update", timed("new_time_text")).alias("time_text"), F.when(F.col("tool") == "update", timed("new_time_iso")).alias("scheduled_time"),
            F.lit(None).cast("string").alias("target"), F.when(F.col("tool") == "delete", True).alias("dead"),
        )

    def found(self, hits: DataFrame) -> DataFrame:
        """``at`` and the fields of the version of every reminder that a request means."""
        history = self.base.unionByName(self.changes(hits))
        versions = running(history, ["scope", "rid"], "moment", (*FIELDS, "target", "dead")).where("dead is null and target = 'self'")
        fields = ["rid", *FIELDS]
        keyed = versions.select("scope", "moment", "next", *fields, F.explode(F.array_compact(F.array(*[F.concat(F.lit(f"{k}:"), c) for k, c in (("task", F.col("task")), ("time", squeezed(F.col("time_text"))), ("day", F.substring("scheduled_time", 1, 10)))]))).alias("key"))
        in_time = ~F.col("by_task") | time_matches(F.col("asked_text"), F.col("time_text"), F.col("asked_iso"), F.col("scheduled_time"))
        keys = self.keys.withColumnsRenamed({"time_text": "asked_text", "time_iso": "asked_iso"})
        lasting = (F.col("moment") < 0) & F.col("next").isNull()
        steady = keys.join(keyed.where(lasting).drop("moment", "next").hint(SHUFFLED), ["scope", "key"])
        moving = keyed.where(~lasting)
        blocks = _blocks(F.greatest("moment", F.lit(-1)) + 1, F.coalesce("next", F.lit(self.end)), self.levels)
        placed = moving.withColumn("block", F.explode(blocks)).drop("moment", "next")
        held = keys.join(moving.select("scope", "key").distinct().hint(SHUFFLED), ["scope", "key"], "left_semi").withColumn("block", F.explode(_around(2 * F.col("turn"), self.levels)))
        met = held.join(placed.hint(SHUFFLED), ["scope", "key", "block"])
        fuzzy = [df.where(in_time).select("at", *fields) for df in (steady, met)]
        named = self.asked.where("lacks is null and tool <> 'create'").where(_given("reminder_id"))
        null = F.lit(None)
        lookups = named.select("scope", F.col("reminder_id").alias("rid"), (2 * F.col("turn")).alias("moment"), *[null.cast("string").alias(c) for c in (*FIELDS, "target")], null.cast("boolean").alias("dead"), "at")
        whole = history.withColumn("at", null.cast("long")).unionByName(lookups)
        by_id = running(whole, ["scope", "rid"], "moment", (*FIELDS, "target", "dead")).where("at is not null and dead is null and target is not null")
        return fuzzy[0].unionByName(fuzzy[1]).distinct().unionByName(by_id.select("at", *fields))


def replay(reminders: DataFrame, requests: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """Answers and the snapshot after all requests, as if each were applied before the next.

    ``reminders`` are of the shape of ``store.REMINDER`` with ``scope``, the store
    they belong to.  ``requests`` have ``scope``, ``request_id`` (a whole number, in
    the order of application), ``tool`` (create, query, update or delete),
    ``reminder_id``, ``task``, ``time_text``, ``time_iso``, ``new_task``,
    ``new_time_text`` and ``new_time_iso``.  An answer has ``request_id``,
    ``scope``, ``tool``, ``status``, ``missing_fields``, ``n`` (reminders meant),
    ``reminder_id`` (created, changed or deleted) and ``candidates``, the versions
    meant by a query or an ambiguous request, by id; null for a query of
    everything, whose ``n`` is that of all.

    Ids may repeat in different scopes only.  A null scope is a scope of its own
    for nothing: such rows belong to no store and give no row.
    """
    scratch = Scratch(reminders.sparkSession)
    requests, reminders = requests.where("scope is not null"), reminders.where("scope is not null")
    asked = scratch.save(_judged(requests, reminders))
    most = asked.agg(F.max("turn")).first()[0] or 0
    levels = (2 * most + 2).bit_length()
    null = F.lit(None)
    active = reminders.where("status = 'active'").select("scope", F.col("reminder_id").alias("rid"), F.lit(-1).cast("long").alias("moment"), *FIELDS, "target", null.cast("boolean").alias("dead"))
    made = asked.where("made is not null").select("scope", F.col("made").alias("rid"), (2 * F.col("turn") + 1).alias("moment"), "task", "time_text", F.col("time_iso").alias("scheduled_time"), F.lit("self").alias("target"), null.cast("boolean").alias("dead"))
    base = scratch.save(active.unionByName(made))
    renamed = asked.where("tool = 'update' and lacks is null").select(_said("new_task").alias("task"), _said("new_time_text").alias("time_text"))
    keys = _keys(asked, base.select("task", "time_text").unionByName(renamed), scratch)
    whole = store = _Store(base, asked, keys, levels, 1 << levels)
    hits = scratch.save(asked.where("false").select("scope", "at", F.lit("").alias("rid")))
    takes = asked.where("tool in ('update', 'delete') and not unread").select("at", "scope")
    settled: list[tuple[DataFrame, DataFrame]] = []
    while True:
        found = scratch.save(store.found(hits))
        one = found.groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("rid")).where("n = 1")
        following = scratch.save(one.join(takes.hint(SHUFFLED), "at").select("scope", "at", "rid"))
        moved = following.join(hits.hint(SHUFFLED), ["at", "rid"], "left_anti").unionByName(hits.join(following.hint(SHUFFLED), ["at", "rid"], "left_anti"))
        open_scopes = scratch.save(moved.select("scope").distinct())
        settled.append((found, following))
        if open_scopes.isEmpty():
            break
        # a settled scope keeps what was found last; the others go on alone
        left = lambda df: df.join(open_scopes.hint(SHUFFLED), "scope", "left_semi")  # noqa: E731, B023
        store = _Store(*[scratch.save(left(df)) for df in (store.base, store.asked, store.keys)], levels, 1 << levels)
        own = store.asked.select("at").hint(SHUFFLED)
        settled[-1] = (found.join(own, "at", "left_anti"), following.join(own, "at", "left_anti"))
        hits = scratch.save(left(following))
    store = whole
    found, hits = (scratch.save(reduce(DataFrame.unionByName, part)) for part in zip(*settled, strict=True))
    answers = scratch.save(_answers(store, asked, found, hits))
    changes = store.changes(hits)
    last = changes.groupBy("scope", "rid").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("moment"))).alias(f"new_{c}") for c in FIELDS], F.max("dead").alias("gone"))
    stamp = F.lit(now)
    created = made.select("scope", F.col("rid").alias("reminder_id"), *FIELDS, "target", F.lit("active").alias("status"), stamp.alias("created_at"), stamp.alias("updated_at"), null.cast("string").alias("notified_at"))
    every = reminders.unionByName(created, allowMissingColumns=True).join(last.withColumnsRenamed({"scope": "c_scope"}).hint(SHUFFLED), (F.col("scope") == F.col("c_scope")) & (F.col("reminder_id") == F.col("rid")) & (F.col("status") == "active"), "left")
    touched = F.col("rid").isNotNull()
    values = {c: F.coalesce(f"new_{c}", c) for c in FIELDS} | {"status": F.when(F.col("gone"), "deleted").otherwise(F.col("status")), "updated_at": F.when(touched, stamp).otherwise(F.col("updated_at"))}
    return answers, every.select(*[values.get(c, F.col(c)).alias(c) for c in reminders.columns])


def _answers(store: _Store, asked: DataFrame, found: DataFrame, hits: DataFrame) -> DataFrame:
    tool = F.col("tool")
    facts = F.array_sort(F.collect_list(F.struct(F.col("rid").alias("reminder_id"), "task", "scheduled_time")))
    meant = found.groupBy("at").agg(facts.alias("facts"), F.count(F.lit(1)).alias("found"))
    gone = hits.drop("scope").join(asked.where("tool = 'delete'").select("at", "turn", "scope").hint(SHUFFLED), "at").join(store.base.where("target = 'self'").select("scope", "rid").hint(SHUFFLED), ["scope", "rid"], "left_semi")
    steps = store.base.where("target = 'self'").select("scope", "moment", F.lit(1).alias("alive"), F.lit(None).cast("long").alias("at"))
    steps = steps.unionByName(gone.select("scope", (2 * F.col("turn") + 1).alias("moment"), F.lit(-1).alias("alive"), F.lit(None).cast("long").alias("at")))
    steps = steps.groupBy("scope", "moment").agg(F.sum("alive").alias("alive"), F.max("at").alias("at"))
    steps = steps.unionByName(asked.where("all").select("scope", (2 * F.col("turn")).alias("moment"), F.lit(0).cast("long").alias("alive"), "at"))
    alive = running(steps, ["scope"], "moment", sums=("alive",)).where("at is not null").select("at", "alive")
    out = asked.join(meant.hint(SHUFFLED), "at", "left").join(alive.hint(SHUFFLED), "at", "left")
    n = F.when(F.col("lacks").isNotNull() | (tool == "create"), 0).when(F.col("all"), F.col("alive")).otherwise(F.coalesce("found", F.lit(0)))
    out = out.withColumn("n", n.cast("long"))
    status = (
        F.when(F.col("lacks").isNotNull(), "missing_fields")
        .when(tool == "create", "success")
        .when(F.col("n") == 0, "not_found")
        .when((tool != "query") & (F.col("n") > 1), "ambiguous")
        .when(F.col("unread"), "missing_fields")
        .otherwise("success")
    )
    out = out.withColumn("status", status)
    fields = F.when(F.col("lacks").isNotNull(), F.col("lacks")).when(F.col("status") == "missing_fields", F.array(F.lit("new_time_text")))
    one = F.when((F.col("status") == "success") & (tool != "query"), F.coalesce("made", F.get("facts", F.lit(0))["reminder_id"]))
    shown = F.when((F.col("status") == "ambiguous") | (tool == "query"), F.col("facts"))
    return out.select("request_id", "scope", "tool", "status", fields.alias("missing_fields"), "n", one.alias("reminder_id"), shown.alias("candidates"))
