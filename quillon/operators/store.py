"""Reminders as snapshots: fuzzy lookup, mutations that give a new snapshot, and the difference of two."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.text import STOP_WORDS, squeezed, stems, strip
from quillon.scratch import SHUFFLED, Scratch

REMINDER = "reminder_id string, task string, scheduled_time string, time_text string, target string, status string, created_at string, updated_at string, notified_at string"
BLOCK, PAIRS = 512, 10_000_000


def active(df: DataFrame) -> DataFrame:
    return df.where("status = 'active'")


def next_number(df: DataFrame, column: str, separator: str = "_") -> DataFrame:
    """``next_number`` and ``next_id``: one after the largest number behind the separator; malformed ids count for nothing."""
    number = F.expr(f"try_cast(split_part(`{column}`, '{separator}', 2) as int)")
    following = F.coalesce(F.max(number), F.lit(0)) + 1
    return df.agg(following.alias("next_number")).withColumn("next_id", F.format_string("rem_%04d", "next_number"))


def _grams(x: Column, n: int) -> Column:
    """Distinct runs of n characters."""
    at = F.sequence(F.lit(1), F.greatest(F.length(x) - (n - 1), F.lit(1)))
    return F.when(F.length(x) >= n, F.array_distinct(F.transform(at, lambda i: F.substring(x, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def contained_pairs(needles: DataFrame, hay: DataFrame) -> DataFrame:
    """``needle`` and ``hay`` of every text of ``hay`` that contains one of ``needles`` (one column each, not empty).

    A posting list of runs of three characters is asked for a needle's rarest
    run; a needle shorter than that is a run itself.  Only runs that some needle
    asks for are posted.
    """
    needles, hay = (df.toDF(n).where(F.col(n) != "").distinct() for df, n in ((needles, "needle"), (hay, "hay")))
    long = F.length("needle") >= 3
    wanted = needles.select("needle", F.when(long, _grams(F.col("needle"), 3)).otherwise(F.array("needle")).alias("keys"))
    asked = wanted.select("needle", F.size("keys").alias("size"), F.explode("keys").alias("gram"))
    runs = hay.select("hay", F.explode(_grams(F.col("hay"), 3)).alias("gram")).unionByName(hay.select("hay", F.explode(F.concat(_grams(F.col("hay"), 1), _grams(F.col("hay"), 2))).alias("gram")))
    posted = runs.join(asked.select("gram").distinct(), "gram", "left_semi")
    df = posted.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    rarest = asked.join(df, "gram").groupBy("needle", "size").agg(F.min(F.struct("df", "gram")).alias("m"), F.count(F.lit(1)).alias("known")).where("known = size")
    return rarest.select("needle", F.col("m.gram").alias("gram")).join(posted, "gram").where(F.contains("hay", F.col("needle"))).select("needle", "hay")


def _texts(df: DataFrame, scratch: Scratch) -> DataFrame:
    """The distinct texts that are not empty: ``text``, its ``plain`` form, its distinct stems ``every`` and those with a meaning, ``own``; written once."""
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    texts = df.toDF("text").where(F.coalesce("text", F.lit("")) != "").distinct()
    texts = texts.select("text", strip(F.lower("text")).alias("plain"), F.array_distinct(stems(F.col("text"))).alias("every"))
    return scratch.save(texts.withColumn("own", F.array_except("every", stop)))


def task_pairs(queries: DataFrame, tasks: DataFrame) -> DataFrame:
    """``q`` and ``t`` of the distinct texts that ``task_matches``; neither is empty.

    Substrings are found both ways by their characters, meaningful stems by the
    rarest, and texts of stop words alone by any stem.  Normal forms and stems
    are computed once a text.
    """
    scratch = Scratch(queries.sparkSession)
    left, right = _texts(queries, scratch), _texts(tasks, scratch)
    p, r = left.select("plain"), right.select("plain")
    inside = contained_pairs(p, r).toDF("p", "r").unionByName(contained_pairs(r, p).toDF("r", "p")).distinct()
    inside = inside.join(left.select(F.col("plain").alias("p"), F.col("text").alias("q")), "p").join(right.select(F.col("plain").alias("r"), F.col("text").alias("t")), "r").select("q", "t")
    stemmed = _stem_pairs(left.select(F.col("text").alias("q_key"), F.col("own").alias("q")), right.select(F.col("text").alias("t_key"), F.col("own").alias("t"))).toDF("q", "t")
    idle = left.where(F.size("own") == 0).select(F.col("text").alias("q"), F.explode("every").alias("stem"))
    any_stem = idle.join(right.select(F.col("text").alias("t"), F.explode("every").alias("stem")), "stem").select("q", "t")
    return scratch.save(inside.unionByName(stemmed).unionByName(any_stem).distinct())


def _ask(requests: DataFrame) -> DataFrame:
    """``requests`` with ``ask``, all that decides which reminders a request means."""
    wanted, task, time_text = F.nullif("reminder_id", F.lit("")), _said("task"), _said("time_text")
    fuzzy = wanted.isNull()
    day = F.when(fuzzy & time_text.isNotNull(), F.substring("time_iso", 1, 10))
    return requests.withColumn("ask", F.struct(wanted.alias("wanted"), F.when(fuzzy, task).alias("task"), F.when(fuzzy, time_text).alias("time_text"), day.alias("day")))


def _group(kind: str, task: Column | None = None, slot: Column | None = None) -> Column:
    """The reminders of one task text (or id), of one time text and day, or of both."""
    null = F.lit(None).cast("string")
    fields = [null if task is None else task, *([null, null] if slot is None else [slot["time_text"], slot["day"]])]
    return F.struct(F.lit(kind).alias("kind"), *[f.alias(n) for f, n in zip(fields, ("task", "time_text", "day"), strict=True)]).alias("group")


def _slot(text: str, day: Column) -> Column:
    return F.struct(F.col(text).alias("time_text"), day.alias("day"))


def _members(reminders: DataFrame) -> DataFrame:
    """``group`` and ``fact`` of every active reminder, in the group of each kind that it belongs to."""
    fact = lambda p: F.struct(*[F.col(f"{p}{c}").alias(c) for c in ("reminder_id", "task", "scheduled_time")]).alias("fact")
    slot = _slot("r_time_text", F.substring("r_scheduled_time", 1, 10))
    kinds = F.array(_group("task", F.col("r_task")), _group("time", slot=slot), _group("both", F.col("r_task"), slot))
    return _live(reminders).select(F.explode(kinds).alias("group"), fact("r_")).unionByName(active(reminders).select(_group("id", F.col("reminder_id")), fact("")))


def _links(asked: DataFrame, reminders: DataFrame, scratch: Scratch) -> DataFrame:
    """``ask`` and ``group``: the groups of reminders that each distinct ask means, all of one kind, so that none meets a reminder twice."""
    asks = scratch.save(asked.select("ask").distinct().select("ask", "ask.*", F.struct("ask.time_text", "ask.day").alias("said")))
    live = _live(reminders).select("r_task", _slot("r_time_text", F.substring("r_scheduled_time", 1, 10)).alias("slot"))
    classes = scratch.save(live.distinct())
    by_id = asks.where("wanted is not null").select("ask", _group("id", F.col("wanted")))
    tasked = asks.where("task is not null")
    hits = tasked.join(task_pairs(tasked.select("task"), classes.select("r_task")), F.col("task") == F.col("q"))
    by_task = hits.where("time_text is null").select("ask", _group("task", F.col("t")))
    timed = asks.where("time_text is not null").select("said").distinct()
    slots = classes.select("slot").distinct()
    said, stored = squeezed(F.col("said.time_text")), squeezed(F.col("slot.time_text"))
    x, y = timed.select(said), slots.select(stored)
    texts = contained_pairs(x, y).toDF("x", "y").unionByName(contained_pairs(y, x).toDF("y", "x")).distinct()
    by_text = timed.join(texts, said == F.col("x")).join(slots, F.col("y") == stored).select("said", "slot")
    by_day = timed.join(slots, F.col("said.day") == F.col("slot.day")).select("said", "slot")
    in_time = scratch.save(by_text.unionByName(by_day).distinct())
    by_time = asks.where("task is null and time_text is not null").join(in_time, "said").select("ask", _group("time", slot=F.col("slot")))
    both = hits.where("time_text is not null").select("ask", "said", F.col("t").alias("r_task")).join(in_time, "said").join(classes, ["r_task", "slot"])
    by_both = both.select("ask", _group("both", F.col("r_task"), F.col("slot")))
    return scratch.save(by_id.unionByName(by_task).unionByName(by_time).unionByName(by_both))


def _blocks(rows: DataFrame, key: str, item: str, name: str) -> DataFrame:
    """``key`` and ``name``, lists of about ``BLOCK`` items of one key."""
    sizes = rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_n"))
    return rows.join(sizes, key).groupBy(key, F.pmod(F.xxhash64(item), "_n").alias("_block")).agg(F.collect_list(item).alias(name)).drop("_block")


def candidates(requests: DataFrame, reminders: DataFrame) -> DataFrame:
    """``request_id`` and ``reminder_id`` of the active reminders that a request means.

    A request has ``request_id``, ``reminder_id``, ``task``, ``time_text`` and
    ``time_iso``.  An id decides alone.  Requests that say the same are looked up
    once, through indexes, among the groups of reminders that say the same
    (``_links``); a request without a task is looked up by its time text and its
    date.  A request that names neither means every reminder and has no row here:
    ``answers`` counts it without pairing it.

    The pairs are made at the end, from lists of requests and of reminders, in
    tasks of about ``PAIRS`` each, so that their number grows with the result.
    """
    scratch = Scratch(requests.sparkSession)
    asked = _ask(requests).select("ask", "request_id")
    links = _links(asked, reminders, scratch)
    meant = _members(reminders).select("group", "fact.reminder_id").join(links.select("group").distinct(), "group", "left_semi")
    left, right = (scratch.save(b) for b in (_blocks(asked, "ask", "request_id", "requests"), _blocks(meant, "group", "reminder_id", "reminders")))
    sizes = lambda df, key, c: df.groupBy(key).agg(F.sum(F.size(c)).alias(f"n_{c}"))
    sized = links.join(sizes(left, "ask", "requests"), "ask").join(sizes(right, "group", "reminders"), "group")
    total = sized.agg(F.sum(F.col("n_requests") * F.col("n_reminders"))).first()[0] or 0
    tasks = max(int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // PAIRS + 1)
    lists = left.join(links, "ask").join(right, "group").select("requests", "reminders").repartition(tasks)
    return lists.select(F.explode("requests").alias("request_id"), "reminders").select("request_id", F.explode("reminders").alias("reminder_id"))


def _said(c: str) -> Column:
    """The text, or null if it is blank."""
    return F.when(strip(F.col(c)) != "", F.col(c))


def _live(reminders: DataFrame) -> DataFrame:
    return active(reminders).where("target = 'self'").select(*[F.col(c).alias(f"r_{c}") for c in ("reminder_id", "task", "time_text", "scheduled_time")])


def answers(requests: DataFrame, reminders: DataFrame, listed: bool = True) -> DataFrame:
    """The answer to every query, update and delete request, from one snapshot.

    ``requests`` adds ``tool``, ``new_task``, ``new_time_text`` and ``new_time_iso``
    to what ``candidates`` takes.  Returned: ``request_id``, ``tool``, ``status``
    (success, missing_fields, not_found or ambiguous), ``missing_fields``, ``n``
    (reminders meant), ``reminder_id`` (the one an update or delete goes to) and
    ``candidates``, the reminders of a success of a query or of an ambiguity,
    by id; null for a query of everything, whose ``n`` is that of all.  Reminders
    are counted by groups, once for all requests that ask the same; without
    ``listed`` there is no ``candidates`` and no list is made.
    """
    scratch = Scratch(requests.sparkSession)
    tool, given = F.col("tool"), lambda c: F.coalesce(c, F.lit("")) != ""
    nothing_new = (tool == "update") & ~given("new_time_text") & ~given("new_task")
    nowhere = ~given("reminder_id") & ~given("time_text") & ~given("task")
    missing = F.when(nothing_new, F.array(F.lit("new_time_text|new_task"))).when(nowhere & (tool != "query"), F.array(F.lit("reminder_id|time_text|task")))
    judged = requests.withColumn("lacks", missing)
    judged = _ask(judged)
    links = _links(judged.where("lacks is null"), reminders, scratch)
    members = scratch.save(_members(reminders).join(links.select("group").distinct(), "group", "left_semi"))
    sizes = members.groupBy("group").agg(F.count(F.lit(1)).alias("size"), F.min("fact.reminder_id").alias("first"))
    meant = links.join(sizes, "group").groupBy("ask").agg(F.sum("size").alias("found"), F.min("first").alias("one"))
    if listed:
        meant = meant.join(links.join(members, "group").groupBy("ask").agg(F.array_sort(F.collect_list("fact")).alias("facts")), "ask")
    everything = _live(reminders).agg(F.count(F.lit(1)).alias("everything"))
    out = judged.join(meant, "ask", "left").join(F.broadcast(everything))  # one row
    n = F.when(F.col("lacks").isNotNull(), 0).when(nowhere, F.col("everything")).otherwise(F.coalesce("found", F.lit(0)))
    unread = (tool == "update") & given("new_time_text") & F.col("new_time_iso").isNull()
    status = (
        F.when(F.col("lacks").isNotNull(), "missing_fields")
        .when(n == 0, "not_found")
        .when((tool != "query") & (n > 1), "ambiguous")
        .when(unread, "missing_fields")
        .otherwise("success")
    )
    out = out.withColumn("n", n.cast("long")).withColumn("status", status)
    fields = F.when(F.col("lacks").isNotNull(), F.col("lacks")).when(F.col("status") == "missing_fields", F.array(F.lit("new_time_text")))
    one = F.when((F.col("status") == "success") & (tool != "query"), F.col("one"))
    shown = [F.when((F.col("status") == "ambiguous") | (tool == "query"), F.col("facts")).alias("candidates")] if listed else []
    return out.select("request_id", "tool", "status", fields.alias("missing_fields"), "n", one.alias("reminder_id"), *shown)


def applied(reminders: DataFrame, requests: DataFrame, results: DataFrame, now: str) -> DataFrame:
    """The snapshot after the successful updates and deletes of ``answers``.

    Of several requests for one reminder that of the smallest ``request_id``
    counts; the others came too late for it.  Where each request must see what
    the ones before it did, use ``replay.replay``.
    """
    first = results.where("status = 'success' and reminder_id is not null").groupBy("reminder_id").agg(F.min(F.struct("request_id", "tool")).alias("one"))
    first = Scratch(requests.sparkSession).save(first.select("reminder_id", F.col("one.request_id").alias("request_id"), F.col("one.tool").alias("tool")))
    gone = first.where("tool = 'delete'").select("reminder_id", F.lit("success").alias("status"))
    changes = first.where("tool = 'update'").join(requests.select("request_id", _said("new_task").alias("new_task"), _said("new_time_text").alias("new_time_text"), "new_time_iso"), "request_id")
    return delete(update(reminders, changes, now), gone, now)


def stem_candidates(requests: DataFrame, reminders: DataFrame, request_key: str, query: str, reminder_key: str, task: str) -> DataFrame:
    """Pairs whose meaningful query stems are all in the task, by an inverted index on the rarest stem."""
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    meaning = lambda c: F.array_distinct(F.array_except(stems(F.col(c)), stop))
    return _stem_pairs(requests.select(F.col(request_key).alias("q_key"), meaning(query).alias("q")), reminders.select(F.col(reminder_key).alias("t_key"), meaning(task).alias("t")))


def _stem_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """``q_key`` and ``t_key`` where all of ``q`` are among ``t``, found by the rarest."""
    posted = right.select("t_key", "t", F.explode("t").alias("stem"))
    df = posted.groupBy("stem").agg(F.count(F.lit(1)).alias("df"))
    rarest = left.select("q_key", "q", F.explode("q").alias("stem")).join(df, "stem").groupBy("q_key", "q").agg(F.min(F.struct("df", "stem")).alias("m"), F.count(F.lit(1)).alias("known"))
    asked = rarest.where(F.col("known") == F.size("q")).select("q_key", "q", F.col("m.stem").alias("stem"))
    return asked.join(posted, "stem").where(F.size(F.array_except("q", "t")) == 0).select("q_key", "t_key")


def outcome(matches: DataFrame, requests: DataFrame) -> DataFrame:
    """``request_id``, ``status`` (not_found, ambiguous or success), ``n`` and the one ``reminder_id``."""
    counted = matches.groupBy("request_id").agg(F.count(F.lit(1)).alias("n"), F.min("reminder_id").alias("only"))
    n = F.coalesce("n", F.lit(0))
    status = F.when(n == 0, "not_found").when(n > 1, "ambiguous").otherwise("success")
    return requests.select("request_id").join(counted, "request_id", "left").select("request_id", status.alias("status"), n.alias("n"), F.when(n == 1, F.col("only")).alias("reminder_id"))


def create(reminders: DataFrame, requests: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """New snapshot and results (``request_id``, ``status``, ``missing_fields``, ``reminder_id``); ids go on from the largest."""
    absent = lambda c: F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit(c))
    missing = F.filter(F.array(absent("task"), absent("time_text"), F.when(F.coalesce(F.trim("time_text"), F.lit("")) != "", F.when(F.col("time_iso").isNull(), F.lit("time_text")))), lambda x: x.isNotNull())
    judged = requests.withColumn("missing_fields", missing)
    start = next_number(reminders, "reminder_id").select("next_number")
    made = numbered(judged.where(F.size("missing_fields") == 0), "request_id", "_n").join(F.broadcast(start))  # one row
    made = made.withColumn("new_id", F.format_string("rem_%04d", F.col("next_number") + F.col("_n")))
    null = F.lit(None).cast("string")
    rows = made.select(F.col("new_id").alias("reminder_id"), "task", F.col("time_iso").alias("scheduled_time"), "time_text", F.lit("self").alias("target"), F.lit("active").alias("status"), F.lit(now).alias("created_at"), F.lit(now).alias("updated_at"), null.alias("notified_at"))
    results = judged.join(made.select("request_id", "new_id"), "request_id", "left").select("request_id", F.when(F.size("missing_fields") > 0, "missing_fields").otherwise("success").alias("status"), "missing_fields", F.col("new_id").alias("reminder_id"))
    return reminders.unionByName(rows, allowMissingColumns=True), results


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """``df`` with its rows numbered from 0 by the whole number ``order``: counted by ranges of 65536, numbered within each."""
    cut = F.shiftright(F.col(order).cast("long"), 16)
    counts = df.groupBy(cut.alias("_range")).agg(F.count(F.lit(1)).alias("_count"))
    base = counts.select("_range", F.coalesce(F.sum("_count").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    return df.withColumn("_range", cut).withColumn("_own", own).join(base.hint(SHUFFLED), "_range").withColumn(name, F.col("_base") + F.col("_own")).drop("_range", "_own", "_base")


def delete(reminders: DataFrame, results: DataFrame, now: str) -> DataFrame:
    """Snapshot in which the reminders of successful results are marked deleted."""
    gone = results.where("status = 'success'").select("reminder_id").distinct().withColumn("_gone", F.lit(True))
    hit = F.col("_gone").isNotNull()
    return reminders.join(gone, "reminder_id", "left").withColumn("status", F.when(hit, "deleted").otherwise(F.col("status"))).withColumn("updated_at", F.when(hit, F.lit(now)).otherwise(F.col("updated_at"))).drop("_gone")


def update(reminders: DataFrame, changes: DataFrame, now: str) -> DataFrame:
    """Snapshot with ``new_task``, ``new_time_text`` and ``new_time_iso`` of ``changes`` (one row a ``reminder_id``) put in."""
    own = changes.select("reminder_id", "new_task", "new_time_text", "new_time_iso", F.lit(True).alias("_hit"))
    out = reminders.join(own, "reminder_id", "left")
    for old, new in (("task", "new_task"), ("time_text", "new_time_text"), ("scheduled_time", "new_time_iso")):
        out = out.withColumn(old, F.coalesce(new, old))
    return out.withColumn("updated_at", F.when(F.col("_hit"), F.lit(now)).otherwise(F.col("updated_at"))).drop("new_task", "new_time_text", "new_time_iso", "_hit")


def last_of(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))
    return df.withColumn("_r", rank).where("_r = 1").drop("_r")


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, columns: list[str], by: str | None = None) -> DataFrame:
    """``created_count``, ``deleted_count`` and ``changed_count`` between snapshots of one row a key, by a column if asked."""
    side = lambda df, n: df.select(F.col(key).alias(f"k_{n}"), F.struct(*columns).alias(f"v_{n}"), *([F.col(by).alias(f"g_{n}")] if by else []))
    both = side(before, "b").join(side(after, "a"), F.col("k_b") == F.col("k_a"), "full_outer")
    created, deleted = F.col("k_b").isNull(), F.col("k_a").isNull()
    changed = ~created & ~deleted & ~F.col("v_a").eqNullSafe(F.col("v_b"))
    aggs = [F.count_if(created).alias("created_count"), F.count_if(deleted).alias("deleted_count"), F.count_if(changed).alias("changed_count")]
    return both.groupBy(F.coalesce("g_b", "g_a").alias(by)).agg(*aggs) if by else both.agg(*aggs)


def call_error(name: Column, registered: Column, arguments: Column, kind: Column, required: list[str]) -> Column:
    """First error of a tool call, or null: unsupported tool, malformed arguments, arguments that are no object, missing fields."""
    missing = F.array_join(F.filter(F.array(*[F.lit(r) for r in required]), lambda r: F.coalesce(F.element_at(arguments, r), F.lit("")) == ""), ",")
    return (
        F.when(name.isNull() | (name == "") | ~registered, F.lit("unknown_tool"))
        .when(kind == "invalid", F.lit("malformed_json"))
        .when(kind != "object", F.lit("arguments_not_object"))
        .when(missing != "", F.concat(F.lit("missing_fields:"), missing))
    )
