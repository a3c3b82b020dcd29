"""Documents that failed are asked for again; nothing is searched anew."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.coverage import latest, unresolved_failures
from ..sources.documents import write_documents
from ..shared import cut


def retry_failed(ledger: DataFrame, fetch: Callable[[DataFrame], DataFrame], folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(resolutions, failures) to append to the ledger(item_id, document_id, reason, observed_at, resolved, item, doc).

    Each document that no entry resolves is fetched once, however often it failed; entries without item or doc can't
    be. fetch returns its rows with file_name, body and reason (null: success). A document with a name is written
    under folder; one without is resolved and not written.
    """
    open_ = unresolved_failures(ledger).where("item is not null and doc is not null")
    open_ = latest(open_.select("item_id", "document_id", "observed_at", "item", "doc").withColumn("ordinal", F.lit(0)), ["item_id", "document_id"]).select("item_id", "document_id", "item", "doc")
    open_ = cut(open_)
    tried = cut(fetch(open_).select("item_id", "document_id", "file_name", "body", "reason").join(open_, ["item_id", "document_id"]))
    good = tried.where("reason is null")
    if folder is None:
        sizes = good.select("item_id", "document_id", F.lit(None).cast("long").alias("bytes"))
    else:
        named = write_documents(good.where("file_name is not null").select("item_id", "document_id", "file_name", "body"), folder)
        sizes = cut(named.select("item_id", "document_id", "bytes").unionByName(good.where("file_name is null").select("item_id", "document_id", F.lit(None).cast("long").alias("bytes"))))
    resolved = sizes.select("item_id", "document_id", F.lit(True).alias("resolved"), "bytes")
    failed = tried.where("reason is not null").select("item_id", "document_id", "reason", F.lit(False).alias("resolved"), "item", "doc")
    return resolved, failed


def document_outcomes(items: DataFrame, resolved: DataFrame, failed: DataFrame) -> DataFrame:
    """items(item_id, document_id, ...) with bytes and status: fetched, failed, or null where never tried."""
    tried = resolved.select("item_id", "document_id", "bytes", F.lit("fetched").alias("status")).unionByName(failed.select("item_id", "document_id", F.lit(None).cast("long").alias("bytes"), F.lit("failed").alias("status")))
    return items.join(tried, ["item_id", "document_id"], "left")
