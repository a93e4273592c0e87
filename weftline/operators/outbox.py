"""Mail that a deal's stage asks for: messages and what they change at the deal, each sent once.

A batch works out which deals are due and enters its messages into a keyed
snapshot, by deal and version, under the batch's transaction. What has been
entered and not acknowledged is to be sent. A batch that runs again, after a
crash or by mistake, finds its transaction there and adds nothing, and a version
that any batch has entered for a deal is never entered for it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import cells, contact, firm
from weftline.operators.keyed_store import KeyedStore

# The stage that asks for each version, and what a version sets besides.
VERSION_OF = {"M1V1 Sent": "M1V1", "M1V2 Sent": "M1V2"}
WITH_LINK = ("M1V1",)

MESSAGES = "deal_id long, version string, email string, subject string, body string, properties map<string,string>, txn string, sent boolean"


def due(deals: DataFrame, firms: DataFrame, people: DataFrame, templates: DataFrame, owner: str, link: str) -> DataFrame:
    """deals (deal_id, stage, domain, sent_version) in a stage that asks for mail, with version, skip (null, 'already sent' or 'no contact') and for those that aren't skipped email, subject, body, properties.

    firms has domain and company_name, people domain, rank, name and email,
    templates (a row for each version) version, subject and body with
    placeholders. A deal's person is its firm's first.
    """
    version = F.element_at(F.create_map(*[F.lit(x) for kv in VERSION_OF.items() for x in kv]), F.col("stage"))
    asked = deals.withColumn("version", version).where("version IS NOT NULL")
    first = people.where("rank = 1").select("domain", "name", "email")
    met = asked.join(firms.select("domain", "company_name"), "domain", "left").join(first, "domain", "left").join(F.broadcast(templates.select("version", "subject", "body").limit(len(VERSION_OF))), "version", "left")
    skip = F.when(F.col("sent_version") == F.col("version"), "already sent").when(F.col("company_name").isNull() | ~firm.filled(F.col("email")), "no contact")
    values = {"{{contact.firstname}}": contact.first_name(F.col("name")), "{{company.name}}": F.col("company_name"), "{{owner.first_name}}": F.lit(owner), "[CALENDLY_LINK]": F.lit(link)}
    sent = lambda c: F.when(F.col("skip").isNull(), c)
    properties = cells.drop_empty(email_version_sent=F.col("version"), calendly_link_sent=F.when(F.col("version").isin(*WITH_LINK), "true"))
    return met.withColumn("skip", skip).select(
        "deal_id", "version", "skip", sent(F.col("email")).alias("email"), sent(cells.render(F.col("subject"), {k: values[k] for k in ("{{company.name}}", "{{contact.firstname}}")})).alias("subject"),
        sent(cells.render(F.col("body"), values)).alias("body"), sent(properties).alias("properties"),
    )


def outbox(spark, folder: str) -> KeyedStore:
    return KeyedStore(spark, folder, MESSAGES, ["deal_id", "version"])


def post(box: KeyedStore, batch: DataFrame, txn: str) -> None:
    """Enters the messages of a batch that no batch has entered yet, all of them or, for a transaction that is known, none."""
    new = batch.where("skip IS NULL").drop("skip").dropDuplicates(["deal_id", "version"])
    fresh = new.join(box.rows().select("deal_id", "version"), ["deal_id", "version"], "left_anti")
    box.put(fresh.withColumns({"txn": F.lit(txn), "sent": F.lit(False), "entered": F.lit(0)}), "entered", keep=(), txn=f"post {txn}")


def pending(box: KeyedStore) -> DataFrame:
    """The messages that are to be sent, with the properties to set at their deals then."""
    return box.rows().where("NOT sent").drop("sent")


def acknowledge(box: KeyedStore, messages: DataFrame, txn: str) -> None:
    """Notes messages (deal_id, version) as sent."""
    done = box.rows().join(messages.select("deal_id", "version").distinct(), ["deal_id", "version"], "left_semi")
    box.put(done.withColumn("sent", F.lit(True)).withColumn("entered", F.lit(1)), "entered", keep=(), txn=f"sent {txn}")
