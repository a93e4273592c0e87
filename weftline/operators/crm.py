"""Call outcomes, e-mail queues and what a CRM needs created."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import firm

# Fixed values: (outcome, previous version) -> stage, version set, task due, priority, type. 'any' matches what no other row does.
TRANSITIONS = (
    (1, "any", "M1V1 Sent", "M1V1", "1 bd", "MEDIUM", "CALL"),
    (2, "any", "Dead - Rejected", None, None, None, None),
    (3, "any", "Call Attempted", None, "1 bd", "MEDIUM", "CALL"),
    (4, "any", "Call Attempted", None, "2 h", "HIGH", "TODO"),
    (5, "", "M1V2 Sent", "M1V2", "1 bd", "MEDIUM", "CALL"),
    (5, "M1V2", "M1V1 Sent", "M1V1", "1 bd", "HIGH", "CALL"),
    (5, "any", "Dead - No Response", None, None, None, None),
)
_COLUMNS = "outcome int, previous string, stage string, version string, due string, priority string, task string"


def transitions(spark) -> DataFrame:
    return spark.createDataFrame(list(TRANSITIONS), _COLUMNS)


def step(calls: DataFrame) -> DataFrame:
    """calls (outcome, previous) with the transition each makes; an outcome without one gets a null stage.

    The exact row of the table wins over the 'any' row; the table has seven rows, fixed.
    """
    table = transitions(calls.sparkSession)
    exact = table.where("previous <> 'any'").select("outcome", "previous", F.struct("stage", "version", "due", "priority", "task").alias("e"))
    other = table.where("previous = 'any'").select("outcome", F.struct("stage", "version", "due", "priority", "task").alias("a"))
    joined = calls.withColumn("previous", F.when(F.coalesce("previous", F.lit("")).isin("", "None"), "").otherwise(F.col("previous"))).join(F.broadcast(exact), ["outcome", "previous"], "left").join(F.broadcast(other), "outcome", "left")
    return joined.withColumn("t", F.coalesce("e", "a")).select(*[c for c in joined.columns if c not in ("e", "a")], "t.*")


def _known() -> Column:
    return F.coalesce(F.col("outcome").isin(*sorted({o for o, *_ in TRANSITIONS})), F.lit(False))


def unknown_outcomes(outcomes: DataFrame) -> DataFrame:
    """The outcomes, null among them, for which there is no transition: for someone to look at."""
    return outcomes.where(~_known())


def escalate(outcomes: DataFrame) -> DataFrame:
    """(deal_id, n, stage, version): where each deal stands after its outcomes in order of time.

    What the next call does depends on what the last one sent, yet no order is needed to know that: outcome 1
    sends M1V1, a 5 climbs from nothing to M1V2 and from there to M1V1, the others send nothing, and no outcome
    leads back. The version follows from how many of each came, so all is counts and a maximum that Spark
    combines before the shuffle. The stage is the last outcome's, at the version before it. Outcomes without a
    transition change nothing and don't count; :func:`unknown_outcomes` has them.
    """
    order = F.struct(F.col("ts").isNull(), "ts", F.col("event_id").isNull(), "event_id", "outcome")
    checked = outcomes.where(_known())
    deals = checked.groupBy("deal_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("outcome") == 1).alias("sent"), F.count_if(F.col("outcome") == 5).alias("missed"), F.max_by("outcome", order).alias("outcome"),
    )
    version = lambda sent, missed: F.when((sent > 0) | (missed > 1), "M1V1").when(missed == 1, "M1V2").otherwise("")
    before = version(F.col("sent") - (F.col("outcome") == 1).cast("int"), F.col("missed") - (F.col("outcome") == 5).cast("int"))
    stood = deals.select("deal_id", "n", "outcome", before.alias("previous"), version(F.col("sent"), F.col("missed")).alias("now"))
    return step(stood).select("deal_id", "n", "stage", F.col("now").alias("version"))


# Outcomes in words, and task subjects by outcome and the version before it.
OUTCOMES = {1: "Connected - Interested", 2: "Connected - Rejected", 3: "Connected - Busy", 4: "Wrong Number", 5: "No Pickup"}
SUBJECTS = {1: "Follow up - no meeting booked", 3: "Callback - was busy", 4: "Apollo lookup - wrong number"}
SUBJECT_AGAIN, SUBJECT_FINAL, SUBJECT_CALLBACK = "Call again - no pickup", "Final follow-up call", "Callback - "


def call_results(calls: DataFrame) -> DataFrame:
    """Calls with all that each changes: stage, version, properties, note line and the task with its due time.

    calls has event_id, deal_id, company, outcome, previous, attempts, call_notes, called_at and callback_at.
    A busy call with a time is called back then, at high priority; other tasks fall due after hours or on
    the next business day. A rejection without a reason says so.
    """
    done = step(calls)
    back = (F.col("outcome") == 3) & F.col("callback_at").isNotNull()
    label = F.coalesce(*[F.when(F.col("outcome") == k, v) for k, v in OUTCOMES.items()])
    n = F.coalesce("attempts", F.lit(0)) + 1
    note = F.concat(F.lit("["), F.date_format("called_at", "yyyy-MM-dd HH:mm"), F.lit(" UTC] call #"), n.cast("string"), F.lit(" \u2014 "), label)
    noted = F.when(firm.filled(F.col("call_notes")), F.concat(note, F.lit(": "), "call_notes")).when(F.col("outcome") == 2, F.concat(note, F.lit(" (no reason recorded)"))).otherwise(note)
    noted = F.when(F.col("outcome") == 4, F.concat(noted, F.lit(" | Wrong number - needs Apollo/alternate lookup"))).otherwise(noted)
    weekday = F.weekday("called_at")
    next_day = F.date_add(F.to_date("called_at"), F.when(weekday == 4, 3).when(weekday == 5, 2).otherwise(1)).cast("timestamp")
    due = F.when(back, F.col("callback_at")).when(F.col("due") == "2 h", F.col("called_at") + F.expr("INTERVAL 2 HOURS")).when(F.col("due") == "1 bd", next_day)
    subject = F.when(back, F.trim(F.concat(F.lit(SUBJECT_CALLBACK), "company"))).when((F.col("outcome") == 5) & F.col("task").isNotNull(), F.when(F.col("previous") == "", SUBJECT_AGAIN).otherwise(SUBJECT_FINAL))
    subject = F.coalesce(subject, *[F.when((F.col("outcome") == k) & F.col("task").isNotNull(), v) for k, v in SUBJECTS.items()])
    return done.select(
        "event_id", "deal_id", label.alias("call_outcome"), n.cast("long").alias("call_attempt_count"), "stage", "version", F.when(F.col("outcome") == 1, "true").alias("calendly_link_sent"),
        F.when(F.col("outcome") == 4, "true").alias("needs_number_lookup"), F.when(back, F.col("callback_at")).alias("callback_datetime"), noted.alias("note_line"),
        subject.alias("task_subject"), F.date_format(due, "yyyy-MM-dd HH:mm").alias("task_due"), F.when(back, "HIGH").otherwise(F.col("priority")).alias("task_priority"), F.col("task").alias("task_type"),
    )


def sync_rows(firms: DataFrame, people: DataFrame, deals: DataFrame, second_done: DataFrame) -> DataFrame:
    """(object, key, other): what a sync sends: companies and contacts to upsert, second contacts once, deals only where there is none, and the edges between them.

    firms has domain; people is ranked and has full (all four fields) and real (a name); deals and second_done
    have a domain. One pass over the firms whose first person is full; what exists is anti-joined.
    """
    primary = people.where("rank = 1 AND full").join(firms.select("domain"), "domain", "left_semi").select("domain", F.lower(F.trim("email")).alias("email"))
    second = people.where("rank = 2 AND real").join(primary.select("domain"), "domain", "left_semi").join(second_done.select("domain"), "domain", "left_anti").select("domain", "name")
    new = primary.join(deals.select(F.lower("domain").alias("domain")), "domain", "left_anti")
    row = lambda df, kind, key, other: df.select(F.lit(kind).alias("object"), F.col(key).alias("key"), other.alias("other"))
    none = F.lit(None).cast("string")
    return (
        row(primary, "company", "domain", none).union(row(primary.dropDuplicates(["email"]), "contact", "email", none)).union(row(primary, "contact-company", "email", F.col("domain")))
        .union(row(second, "second-contact", "name", F.col("domain"))).union(row(new, "deal", "domain", none)).union(row(new, "deal-company", "domain", F.col("domain"))).union(row(new, "deal-contact", "domain", F.col("email")))
    )


def pull_feedback(contacts: DataFrame, by_mail: DataFrame) -> DataFrame:
    """(email, domain, outcome, notes): the last feedback by ordinal of each contact that a caller touched, with its firm where the address is known."""
    touched = contacts.where(firm.filled(F.col("call_notes")) | (firm.filled(F.col("call_outcome")) & (F.col("call_outcome") != "Not Called"))).withColumn("email", F.lower(F.trim("email"))).where("email <> ''")
    last = touched.groupBy("email").agg(F.max_by(F.struct("call_outcome", "call_notes"), "ordinal").alias("r"))
    return last.join(by_mail, "email", "left").select("email", "domain", F.coalesce(F.nullif("r.call_outcome", F.lit("")), F.lit("(notes only)")).alias("outcome"), F.col("r.call_notes").alias("notes"))
