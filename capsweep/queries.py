"""The engine's operators over the driver's tables, each with SQL that says the same."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import captured, cli
from .functions import codecs
from .functions import responses as R
from .functions import scalars as S
from .operators import coverage, queues
from .operators.intervals import within
from .plans.frontier import crawl
from .plans import run as runs
from .plans.harvest import HarvestedTraversal
from .plans.retry import retry_failed
from .plans.sweep import Traversal, day_cells, sweep
from .shared import cut, delete, shared_folder
from .sources import documents, html, records, session
from .sources.capped import TableSource, capped
from .stores import Stores
from .streaming.gate import Gate

DAY, ORDER_DAY = "CAST(l_shipdate AS DATE)", "CAST(o_orderdate AS DATE)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_source(spark: SparkSession, sf_dir: str, cap: int) -> TableSource:
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    rows = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws("-", "l_orderkey", F.lpad(F.col("l_linenumber").cast("string"), 2, "0")).alias("item_id"), F.col("l_shipdate").cast("date").alias("day"), F.col("l_returnflag").alias("facet"), F.col("p_name").alias("name")
    )
    return TableSource(rows, cap)


def sweep_cells(spark: SparkSession, sf_dir: str, cap: int = 4) -> DataFrame:
    """The whole adaptive sweep: days, then flags, then part names, where the cap is reached."""
    source = ship_source(spark, sf_dir, cap)
    source.rows = cut(source.rows)  # each level asks it
    low, high = source.rows.agg(F.min("day"), F.max("day")).first()
    rank = lambda df, c, name: df.select(F.col(c).alias(name)).distinct().withColumn("position", F.lit(0))
    traversal = Traversal(rank(table(spark, sf_dir, "lineitem"), "l_returnflag", "facet"), rank(table(spark, sf_dir, "part"), "p_name", "probe"))
    seeds = day_cells(spark, str(low), str(high))
    cells, _ = sweep(source, traversal, seeds)
    return cells.select("unit_key", "window_key", "facet_value", "probe", "depth", "state", F.col("result_count").cast("long").alias("result_count"), "saturated", "item_set_hash")


def harvested_sweep(spark, sf_dir):
    """The sweep with probes of its own: the eight pairs of words that its days and flags have shown most."""
    source = ship_source(spark, sf_dir, 4)
    source.rows = cut(source.rows)
    low, high = source.rows.agg(F.min("day"), F.max("day")).first()
    facets = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("facet")).distinct().withColumn("position", F.lit(0))
    cells, _ = sweep(source, HarvestedTraversal(facets, max_probes=8), day_cells(spark, str(low), str(high)))
    return cells.select("unit_key", "window_key", "facet_value", "probe", "depth", "state", F.col("result_count").cast("long").alias("result_count"), "item_set_hash")


def seed_day_cells(spark, sf_dir):
    low, high = table(spark, sf_dir, "orders").agg(F.min(F.col("o_orderdate").cast("date")), F.max(F.col("o_orderdate").cast("date"))).first()
    return day_cells(spark, str(low), str(high)).select("unit_key", F.date_format("date_from", "yyyy-MM-dd").alias("day"))


def event_cells(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(F.date_format("ts", "yyyy-MM-dd").alias("window_key"), F.col("event_type").alias("facet_value"), "event_id", "ts").withColumn("unit_key", F.concat_ws("|", "window_key", "facet_value"))


def cell_state_counts(spark, sf_dir):
    n = event_cells(spark, sf_dir).groupBy("unit_key").agg(F.count("*").alias("n"))
    cap = F.lit(60)
    return n.select(S.cell_state(F.col("n"), cap).alias("state"), S.is_saturated(F.col("n"), cap).alias("saturated")).groupBy("state", "saturated").agg(F.count("*").alias("cells"))


def item_set_hash(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderkey").cast("string").alias("id"))
    return o.groupBy("day").agg(F.collect_list("id").alias("ids")).select("day", S.set_hash(F.col("ids")).alias("item_set_hash"))


def latest_per_key(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return coverage.latest(e, "user_id", "ts", "event_id").select("user_id", "event_id", "event_type")


def run_summary(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("unit_key"), F.col("ts").alias("observed_at"), F.col("event_id").alias("ordinal"), F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "subdivided").when(F.col("value") > 50, "truncated").otherwise("complete").alias("state"), F.when(F.col("value") > 10, F.lit(1)).alias("unresolved"))
    return coverage.summary(e)


def partition_invariant(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("w"), "o_orderpriority")
    whole = o.groupBy("w").agg(F.least(F.count("*"), F.lit(10)).alias("n")).select(F.col("w").alias("window_key"), F.lit(None).cast("string").alias("facet_value"), F.col("n").alias("result_count"), F.create_map(F.lit("date"), F.col("w")).alias("dimensions"))
    part = o.groupBy("w", "o_orderpriority").agg(F.least(F.count("*"), F.lit(2)).alias("n")).select(F.col("w").alias("window_key"), F.col("o_orderpriority").alias("facet_value"), F.col("n").alias("result_count"), F.create_map(F.lit("date"), F.col("w"), F.lit("class"), F.col("o_orderpriority")).alias("dimensions"))
    observed = whole.unionByName(part).withColumns({"unit_key": F.concat_ws("|", "window_key", "facet_value"), "observed_at": F.lit("t"), "ordinal": F.lit(0)})
    return coverage.partition_invariant(observed).where("facet_value is null").select("window_key", F.col("parent_count").cast("long"), F.col("child_sum").cast("long"), "holds")


def facet_invariant(spark, sf_dir):
    """Facets against what is deeper than their latest shallow row: priorities, split by status and, apart, by the customer's last digit."""
    o = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("w"), F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("s"), F.right(F.col("o_custkey").cast("string"), F.lit(1)).alias("c"))
    none = F.lit(None).cast("string")

    def level(most: int, order: int, *by: str) -> DataFrame:
        names = {"w": "date", "p": "class", "s": "status", "c": "digit"}
        rows = o.groupBy(*by).agg(F.least(F.count("*"), F.lit(most)).alias("result_count"))
        return rows.select(F.col("w").alias("window_key"), F.col("p").alias("facet_value") if "p" in by else none.alias("facet_value"), "result_count", F.create_map(*[x for b in by for x in (F.lit(names[b]), F.col(b))]).alias("dimensions"), F.lit(order).alias("ordinal"), F.concat_ws("|", *by).alias("unit_key"))

    observed = level(30, 0, "w").unionByName(level(20, 1, "w", "p")).unionByName(level(6, 2, "w", "p", "s")).unionByName(level(1, 3, "w", "p", "c")).withColumn("observed_at", F.lit("t"))
    return coverage.partition_invariant(observed).select("window_key", "facet_value", F.col("parent_count").cast("long"), F.col("child_sum").cast("long"), "holds")


def pending_anti_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("unit_key"), F.when(F.col("o_orderstatus") == "F", "failed").otherwise("complete").alias("state"), "o_orderpriority")
    return coverage.pending(o.select("unit_key"), o.where("o_orderpriority <> '1-URGENT'"))


def unresolved_failures(spark, sf_dir):
    e = table(spark, sf_dir, "events").where("event_type in ('error', 'purchase')")
    ledger = e.select(F.col("user_id").alias("item_id"), (F.col("event_id") % 7).alias("document_id"), (F.col("event_type") == "purchase").alias("resolved"), "event_id")
    return coverage.unresolved_failures(ledger).select("item_id", "document_id", "event_id")


def bigram_frequency(spark, sf_dir):
    return queues.bigram_frequency(table(spark, sf_dir, "part"), "p_name", "p_partkey").select("probe", "n", F.col("first_seen.o").alias("first_seen"))


def probe_queue(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    f = queues.bigram_frequency(p, "p_name", "p_partkey")
    d = spark.createDataFrame([("DA SILVA", 0), ("DOS SANTOS", 1)], "probe string, position int")
    return queues.probe_queue(f, d).select("probe", F.col("source_rank").cast("int").alias("source_rank"), "n")


def substring_probe_hits(spark, sf_dir):
    """Every word of every part's name as a probe, and the parts whose name contains it; a name meets a probe once."""
    names = table(spark, sf_dir, "part").groupBy(F.lower("p_name").alias("_name")).agg(F.count("*").alias("_n"))
    return queues.probe_hits(names, names.select(F.explode(S.tokens(F.col("_name"))).alias("probe")).distinct())


def span_hits(spark, sf_dir):
    """Lines shipped in the days that follow each order: spans of 0 to 364 days against days with their counts."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.unix_date(F.col("o_orderdate").cast("date")).alias("low")).withColumn("high", F.col("low") + (F.col("o_orderkey") % 365).cast("int"))
    shipped = table(spark, sf_dir, "lineitem").groupBy(F.unix_date(F.col("l_shipdate").cast("date")).alias("day")).agg(F.count("*").alias("n"))
    return within(o, "low", "high", shipped, "day").groupBy("o_orderkey").agg(F.sum("n").alias("lines"), F.count("*").alias("days"))


def name_probe_hits(spark, sf_dir):
    """Every whole part name as a probe."""
    return queues.name_probe_hits(table(spark, sf_dir, "part"), "p_name")


def capped_pages(spark, sf_dir):
    hits = event_cells(spark, sf_dir).select("unit_key", F.col("event_id").alias("item_id"))
    return capped(hits, F.col("item_id"), 30).groupBy("unit_key").agg(F.count("*").alias("n"), F.sum("item_id").alias("ids"))


def seed_ranking(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("ordinal"), F.col("event_type").alias("kind"), F.when(F.col("value") > 50, "truncated").otherwise("complete").alias("cell_state"))
    return queues.ranked_seeds(e, ["purchase", "click"]).select("ordinal", F.col("state_rank").cast("int").alias("state_rank"), F.col("kind_rank").cast("int").alias("kind_rank"))


def yield_decay_stop(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_type") == "purchase").alias("hit"))
    return queues.yield_decay(e, "hit", "event_id", 5, ["user_id"]).where("stopped").groupBy("user_id").agg(F.min("seed_no").cast("long").alias("stop_at"))


def running_budget(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return queues.within_budget(l, ["l_orderkey", "l_linenumber"], "l_orderkey", None, 2)


def retry_decisions(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "error", "transient").when(F.col("event_type") == "click", "hostDefect").when(F.col("event_type") == "view", "sessionExpired").otherwise("permanentError")
    status = F.when(F.col("event_id") % 2 == 0, 429).otherwise(503)
    attempt = (F.col("event_id") % 7 + 1).cast("int")
    wait = S.backoff("exponential", attempt, 1000, 2, cap=60000)
    d = S.decision(kind, status, attempt, wait, F.when(F.col("event_id") % 3 == 0, F.lit(5000)))
    return e.select("event_id", d["action"].alias("action"), d["delay_ms"].alias("delay_ms"))


def backoff_schedule(spark, sf_dir):
    n = F.col("event_id") % 9 + 1
    return table(spark, sf_dir, "events").select("event_id", S.backoff("fixed", n, 250).alias("fixed"), S.backoff("linear", n, 100, 50).alias("linear"), S.backoff("exponential", n, 1000, 2, cap=60000).alias("exponential"))


def rate_gate_schedule(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ready"))
    return queues.rate_gate(e, "ready", "event_id", 500, "user_id").select("event_id", F.col("granted").cast("long").alias("granted"))


def dry_run_forecast(spark, sf_dir):
    low, high = table(spark, sf_dir, "orders").agg(F.min(F.col("o_orderdate").cast("date")), F.max(F.col("o_orderdate").cast("date"))).first()
    f = cli.forecast(low, high, 30, cli.Bounds(max_days=31, max_items=200, max_requests=None))
    return spark.createDataFrame([(f["days"], f["items"], f["documents"], f["requests"], float(f["seconds"]))], "days long, items long, documents long, requests long, seconds double")


def label_code(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(" ("), F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 2 == 0, ")").otherwise("")).alias("t"))
    c = S.labelled_code(F.col("t"))
    return p.select("p_partkey", c["label"].alias("label"), c["code"].alias("code"))


def read_records(spark, sf_dir, parts=tuple(records.PARTS)):
    """Records of all orders' pages, their grids' further pages included."""
    pages = cut(captured.record_pages(spark, sf_dir))
    first = records.read_records(pages.where("page = 1").select("key", "url", "status", "headers", "body"), {*parts, "pager"})
    return records.with_grid_pages(cut(first), pages.where("page > 1").select("key", "page", "status", "headers", "body"))


def outcome_classification(spark, sf_dir):
    """Pages as responses: signals, validity, and the outcomes of a detail and of a search."""
    p, v = R.viewed(captured.record_pages(spark, sf_dir).where("page = 1")), F.col("view")
    return p.select("key", R.view_validity(v).alias("validity"), R.detail_outcome(F.col("status"), F.col("headers"), v)["kind"].alias("detail"), R.search_outcome(F.col("status"), F.col("headers"), v)["kind"].alias("search"))


def search_results(spark, sf_dir):
    """Rows of result tables, with the names of the sides."""
    got = html.extract_results(captured.search_pages(spark, sf_dir))
    return got.select("path", "process_number", "token", "parties", F.array_join(S.party_names(F.col("parties")), "|").alias("names"))


def detail_records(spark, sf_dir):
    r = read_records(spark, sf_dir)
    x, who = F.col("record"), F.try_element_at(F.col("record.parties.active"), F.lit(1))
    return r.select(
        "key", F.col("outcome.kind").alias("kind"), F.coalesce(F.col("outcome.reason"), F.col("outcome.status").cast("string")).alias("reason"), x["process_number"].alias("process_number"), x["case_class"]["label"].alias("class_label"), x["case_class"]["code"].alias("class_code"),
        F.array_join(F.transform(x["subjects"], lambda c: F.concat_ws("/", c["label"], c["code"])), ";").alias("subjects"), x["judging_body"]["name"].alias("body_name"), x["judging_body"]["address"].alias("body_address"), x["filing_date"].alias("filing_date"),
        who["name"].alias("party"), who["cpf"].alias("cpf"), who["cnpj"].alias("cnpj"), who["role"].alias("role"), who["status"].alias("status"),
        F.array_join(F.transform(who["lawyers"], lambda w: F.concat_ws("/", w["name"], w["oab_state"], w["oab_number"], w["cpf"])), ";").alias("lawyers"),
        F.size(x["movements"]).alias("n_movements"), F.array_join(F.transform(x["documents"], lambda d: F.concat_ws("/", d["kind"], d["documentId"], d["label"], d["document_type"])), ";").alias("documents"),
    )


def record_movements(spark, sf_dir):
    """When each movement occurred, read from pages at a fixed offset."""
    pages = captured.record_pages(spark, sf_dir).where("page = 1")
    return records.occurred(records.read_records(pages.select("key", "url", "status", "headers", "body"), ["movements"]))


def document_fetches(spark, sf_dir):
    """Chains of document requests: what each document's fetch comes to, and the file it would be."""
    docs, got = fetches(read_records(spark, sf_dir, ["documents"]))
    return got.select("item_id", F.col("documentId").alias("document_id"), "kind", F.col("outcome.kind").alias("outcome"), F.coalesce(F.col("outcome.reason"), F.col("outcome.status").cast("string")).alias("reason"), "file_name", F.octet_length("body").alias("bytes"), "fetched_bin_id")


def fetches(r):
    """(documents of records, what their requests' chains come to)."""
    docs = cut(r.where("record is not null").select(F.col("key").alias("item_id"), F.col("record.process_number").alias("process_number"), F.explode("record.documents").alias("d")).select("item_id", "process_number", "d.kind", "d.documentId", "d.label", "d.url"))
    return docs, records.fetched_documents(docs, captured.document_chain(docs))


def item_fields(spark, sf_dir):
    """Orders as items whose payloads hold what they may: fields of them by path, after the store has written and read them."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_orderkey")
    party = F.struct(F.col("c_name").alias("name"), F.when(k % 2 == 0, F.col("c_nationkey")).alias("nation"))
    bag = F.to_json(F.struct(F.struct(F.col("o_orderstatus").alias("label"), F.when(k % 3 == 0, k.cast("string")).alias("code")).alias("class"), F.array(party).alias("parties")))
    payload = F.when(k % 5 == 0, F.lit("no JSON")).when(k % 5 == 1, F.concat(F.lit('{"class":['), k.cast("string"), F.lit("]}"))).otherwise(bag)
    stores = Stores(spark, f"{shared_folder(spark)}/run-{uuid.uuid4().hex}")
    none = F.array().cast("array<struct<document_id:string,status:string,bytes:bigint>>")
    stores.append("items", o.select(k.cast("string").alias("item_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("unit_key"), F.lit("r").alias("run_id"), F.lit("t").alias("observed_at"), payload.alias("payload"), none.alias("documents")), "first")
    got = stores.fields({"label": ("$.class.label", "string"), "code": ("$.class.code", "long"), "first": ("$.class[0]", "long"), "party": ("$.parties[0].name", "string"), "nation": ("$.parties[0].nation", "int")})
    got = cut(got)
    delete(spark, stores.folder)
    return got


def shared_uri(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, as an address that files' own libraries take too."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    return folder if "://" in folder else f"file://{folder.removeprefix('file:')}"


def stored_documents(spark, sf_dir):
    """Documents that were fetched, written by the two-phase sink and read back from what it committed."""
    _, got = fetches(read_records(spark, sf_dir, ["documents"]))
    spark.dataSource.register(documents.DocumentFiles)
    folder = shared_uri(spark, "documents")
    got.where("outcome.kind = 'ok'").select("file_name", "body").write.format("document_files").option("path", folder).mode("append").save()
    back = cut(documents.document_bodies(spark, folder).select("file_name", "bytes", F.sha1("body").alias("sha1")))
    delete(spark, folder)
    return back


def refused_responses(spark, sf_dir):
    """Captured responses read back with conditions that the source itself applies: what was refused, and how long it asks to wait."""
    folder = shared_uri(spark, "captured")
    captured.write_captured(captured.record_pages(spark, sf_dir), folder)
    captured.register(spark, push=True)
    try:
        got = spark.read.format("captured_responses").schema("key string, page int, status int, headers map<string,string>").option("path", folder).option("push", "true").load()
        got = cut(got.where("status in (429, 503)").select("key", "page", "status", R.header(F.col("headers"), "retry-after").alias("retry_after")))
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    delete(spark, folder)
    return got


def session_replay(spark, sf_dir):
    """Customers as sessions that search for their orders in turn: a session lasts three searches, and orders of every 17th number end any."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("session"), "o_orderkey")
    searches = cut(o.withColumn("no", F.row_number().over(Window.partitionBy("session").orderBy("o_orderkey")) - 1))  # a customer has few orders
    epoch = F.col("epoch").cast("string")
    page = captured.joined('<form action="/search;jsessionid=s', F.col("session").cast("string"), "e", epoch, '"><input name="javax.faces.ViewState" value="v', epoch, "\"><input name=\"f:n\"></form><script>s({'f:go':'f:go'})</script>")

    def prime(asked):
        return asked.select("session", "epoch", captured.headers().alias("headers"), captured.latin(page).alias("body"))

    def send(asked):
        age = F.substring("state.view_state", 2, 9).cast("int")
        gone = (F.col("o_orderkey") % 17 == 0) | (age < F.floor(F.col("no") / 3))
        body = F.when(gone, '<meta name="Ajax-Response" content="redirect"/>login.seam').otherwise("<table></table>")
        return asked.withColumns({"status": F.lit(200), "headers": captured.headers("text/xml"), "body": captured.latin(body)})

    got = session.replayed(searches, prime, send)
    return got.select("session", "no", "o_orderkey", "epoch", "view_state", "replayed", F.col("outcome.kind").alias("outcome"))


def harvested_seeds(spark, sf_dir):
    """What records name for the frontier: lawyers' numbers, then parties'."""
    pages = captured.record_pages(spark, sf_dir).where("page = 1")
    r = records.read_records(pages.select("key", "url", "status", "headers", "body"), ["parties"]).where("record is not null")
    return r.select("key", F.posexplode(S.harvested_seeds(F.col("record.parties"))).alias("position", "seed")).select("key", "position", "seed.kind", "seed.value")


def row_tolerance(spark, sf_dir):
    """Rows of cells that are tried again: lines of orders, by their numbers' remainders."""
    l = captured.order_lines(spark, sf_dir).select(F.col("l_orderkey").alias("unit_key"), F.col("l_linenumber").alias("position"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("item_id"), (F.col("l_partkey") % 23).alias("m"))
    tries = l.withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(3))))
    kind = F.when((F.col("m") == 0) & (F.col("attempt") == 1), "transient").when(F.col("m") <= 1, "hostDefect").when((F.col("m") == 2) & (F.col("attempt") < 2), "permanentError").when((F.col("m") == 3) & (F.col("attempt") < 3), "hostDefect").otherwise("ok")
    ok, lost, aborted = runs.tolerated(tries.withColumns({"kind": kind, "status": F.lit(503), "reason": F.lit("x  y"), "detail": F.lit("d")}))
    none = F.lit(None).cast("string")
    rows = ok.select("unit_key", "item_id", F.lit("item").alias("what"), none.alias("reason")).unionByName(lost.select("unit_key", "item_id", F.lit("unresolved").alias("what"), "reason"))
    return rows.unionByName(aborted.select("unit_key", none.alias("item_id"), F.lit("aborted").alias("what"), F.concat_ws(":", "kind", "status").alias("reason")))


def order_source(spark, sf_dir, cap):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("item_id"), F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderpriority").alias("facet"), F.lit("x y").alias("name"))
    source = TableSource(cut(o), cap)
    low, high = source.rows.agg(F.min("day"), F.max("day")).first()
    return source, low, high, Stores(spark, f"{shared_folder(spark)}/run-{uuid.uuid4().hex}")


def no_split(spark):
    return Traversal(spark.createDataFrame([], "facet string, position int"), spark.createDataFrame([], "probe string, position int"))


def resume_sweep(spark, sf_dir):
    """A run that its budget stops once and a second one that goes on: the latest checkpoint of every cell."""
    source, low, high, stores = order_source(spark, sf_dir, 5)
    facets = source.rows.select("facet").distinct().withColumn("position", F.lit(0))
    traversal = Traversal(cut(facets), spark.createDataFrame([], "probe string, position int"))
    seeds = day_cells(spark, str(low), str(high))
    for run_id, most in (("first", 1000), ("second", None)):
        runs.run(source, traversal, seeds, stores, run_id, runs.Limits(max_requests=most), runs.FixedClock())
    items = stores.items().groupBy("unit_key").agg(F.count("*").alias("items"))
    got = cut(stores.checkpoints().join(items, "unit_key", "left").select("unit_key", "facet_value", "depth", "state", "result_count", "item_set_hash", F.coalesce("items", F.lit(0)).cast("long").alias("items")))
    delete(spark, stores.folder)
    return got


class Throttled:
    """Every seventh day answers 429 in the first turns: one, two or three of them."""

    cap = None

    def __init__(self, inner, low):
        self.inner, self.low, self.turn = inner, low, 0

    def discover(self, cells):
        self.turn += 1
        n = F.datediff("date_from", F.lit(self.low))
        told = cells.withColumn("wait", (n % 7 == 0) & (F.floor(n / 7) % 3 + 1 >= self.turn))
        bad = told.where("wait").select("unit_key", F.lit(None).cast("string").alias("item_id"), F.lit("transient").alias("kind"), F.lit(429).alias("status"), F.lit(3000).cast("long").alias("retry_after_ms"))
        return self.inner.discover(told.where("not wait").drop("wait")).unionByName(bad, allowMissingColumns=True)


def gated_run(spark, sf_dir):
    """A run through the gate: when each request was granted, from the run's start, and what came of it."""
    source, low, high, stores = order_source(spark, sf_dir, None)
    clock = runs.FixedClock()
    began = round(clock.at.timestamp() * 1000)
    runs.run(Throttled(source, low), no_split(spark), day_cells(spark, str(low), str(high)), stores, "gated", runs.Limits(max_requests=None), clock, gate=Gate(500))
    state = stores.checkpoints().select(F.col("unit_key").alias("request"), "state")
    got = cut(stores.requests().join(state, "request").select(F.col("request").alias("unit_key"), (F.col("granted_ms") - began).alias("granted_ms"), "attempt", "outcome", "state"))
    delete(spark, stores.folder)
    return got


class Paged(TableSource):
    """Rows have pages of their own, which fail by their numbers: for good, twice, or after one other failure in a way that ends their cell."""

    def details(self, rows):
        m, a = F.col("item_id").cast("long") % 23, F.col("attempt")
        kind = F.when(m == 1, "hostDefect").when((m == 2) & (a < 2), "permanentError").when(m == 3, F.when(a == 0, "hostDefect").otherwise("transient")).otherwise("ok")
        return rows.withColumns({"kind": kind, "status": F.lit(503), "reason": F.lit("x"), "detail": F.lit("d")})


def tolerant_run(spark, sf_dir):
    """A run whose rows and documents are tried again: its items with their documents' outcomes, and its ledger."""
    source, low, high, stores = order_source(spark, sf_dir, None)
    documents = lambda items: items.where(F.col("item_id").cast("long") % 5 == 0).select("item_id", F.lit("d").alias("document_id"))

    def fetch(asked):
        k, a = F.col("item_id").cast("long"), F.col("attempt")
        kind = F.when(k % 25 == 0, "permanentError").when((k % 10 == 0) & (a < 3 + k % 4), "transient").otherwise("ok")
        good = kind == "ok"
        return asked.select("item_id", "document_id", F.when(good, F.col("item_id")).alias("file_name"), F.when(good, F.lit(b"%PDF-1")).alias("body"), kind.alias("kind"), F.lit(503).alias("status"), F.when(k % 25 == 0, "gone").alias("reason"), F.lit(None).cast("string").alias("detail"))

    limits = runs.Limits(max_requests=None, max_documents=None, transient_cap=2)
    runs.run(Paged(source.rows, None), no_split(spark), day_cells(spark, str(low), str(high)), stores, "tolerant", limits, runs.FixedClock(), documents, fetch)
    items = stores.items().select("item_id", F.lit("item").alias("what"), F.array_join(F.transform("documents", lambda d: F.concat_ws(":", d["document_id"], d["status"], d["bytes"])), ",").alias("said"))
    ledger = stores.ledger().select("item_id", F.when(F.col("document_id").isNotNull(), "document").when(F.contains("item_id", F.lit("..")), "cell").otherwise("row").alias("what"), F.col("reason").alias("said"))
    got = cut(items.unionByName(ledger))
    delete(spark, stores.folder)
    return got


def rate_gate_cooldown(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ready"), F.when(F.col("event_type") == "error", F.lit(60_000)).alias("cooldown"))
    return queues.rate_gate(e, "ready", "event_id", 500, "user_id", "cooldown").select("event_id", F.col("granted").cast("long").alias("granted"))


def search_bodies(spark, sf_dir):
    """All fields of each customer's search, Latin-1 encoded."""
    c = table(spark, sf_dir, "customer")
    harvested = F.array(*[F.lit(f"j9:{k}{x}") for k, x in zip(S.SEARCH_FIELDS, ("", "Input", "", "", "", "", "", ""), strict=True)])
    body = S.search_body({"nomeParte": F.col("c_name"), "dataAutuacaoInicio": F.lit("01/02/2024"), "dataAutuacaoFim": F.lit("02/02/2024"), "classeJudicial": F.when(F.col("c_custkey") % 2 == 0, F.lit("Ação – ã"))}, harvested, F.lit("j_id1"), F.lit("j9:go"))
    rows = c.select("c_custkey", F.posexplode(body).alias("position", "f")).select("c_custkey", "position", codecs.encode_latin1(F.col("f.name")).alias("name"), codecs.encode_latin1(F.col("f.value")).alias("value"))
    return rows


def class_catalogue(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_type", "p_size").distinct()
    entry = captured.joined('<tr class="richfaces_suggestionEntry"><td></td><td>', F.col("p_type"), "</td><td> ", F.when(F.col("p_size") > 25, F.col("p_size").cast("string")).otherwise(""), "</td></tr>")
    body = p.select(F.col("p_type"), captured.joined("<html><table>", entry, "<tr><td>no entry</td></tr></table></html>").cast("binary").alias("body"), captured.headers("text/xml; charset=UTF-8").alias("headers"))
    return records.read_catalogue(body).select("label", "code")


def html_extract(spark, sf_dir):
    return html.extract_links(table(spark, sf_dir, "pages"))


def grid_reconciliation(spark, sf_dir):
    """What grids declare against the documents read of them, and how many of these were fetched."""
    r = cut(read_records(spark, sf_dir, ["documents", "declared_total"]).select("key", "outcome", "record").where("record is not null"))
    return records.with_fetched(r, fetches(r)[1]).select("key", F.col("grid.declaredTotal").alias("declared"), F.col("grid.extractedCount").alias("fetched"), F.col("grid.skippedCount").alias("skipped"), F.col("grid.reportedGap").alias("gap"))


def asof_attach(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    got = queues.last_before(c, "turn", F.col("role") == "user", ["conv_id"], ["turn"], "user_turn")
    return got.where("role = 'assistant'").select("conv_id", "turn", "user_turn")


def log_redaction(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.create_map(F.lit("cpf"), F.col("user_id").cast("string"), F.lit("kind"), F.col("event_type")).alias("fields"))
    m = S.redacted(F.col("fields"))
    return e.select("event_id", m["cpf"].alias("cpf"), m["kind"].alias("kind"))


def slug_path(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(" ("), F.col("p_type"), F.lit(")")).alias("label"))
    return p.select("p_partkey", codecs.document_path(F.col("p_partkey").cast("string"), F.lit("d1"), F.col("label")).alias("path"))


def latin1_form(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = codecs.encode_latin1(F.col("text"))
    return d.select("doc_id", F.length(coded).cast("long").alias("encoded_chars"), F.sha2(coded.cast("binary"), 256).alias("sha256"))


def frontier_crawl(spark, sf_dir):
    """Part names as seeds, over lines behind a cap of 30; only the yield's decay ends it, no budget of requests."""
    source = ship_source(spark, sf_dir, 30)
    source.rows = cut(source.rows)  # each level asks it
    low, high = source.rows.agg(F.min("day"), F.max("day")).first()
    seeds = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ordinal"), F.lit("name").alias("kind"), F.col("p_name").alias("value"), F.when(F.col("p_size") > 25, "truncated").otherwise("complete").alias("cell_state"))
    none = F.lit(None).cast("string")
    cell = lambda s: s.select(F.col("value").alias("unit_key"), F.lit(f"{low}..{high}").alias("window_key"), none.alias("facet_value"), F.col("value").alias("probe"), F.lit(low).alias("date_from"), F.lit(high).alias("date_to"), F.lit(0).alias("depth"), "seed_no")
    return crawl(source, seeds, ["name"], cell, max_requests=None).items


def retry_outcomes(spark, sf_dir):
    """Failed documents, asked for again: those of an even number answer."""
    e = table(spark, sf_dir, "events").where("event_type in ('error', 'purchase')")
    ledger = e.select(F.col("user_id").alias("item_id"), (F.col("event_id") % 7).alias("document_id"), F.col("ts").alias("observed_at"), (F.col("event_type") == "purchase").alias("resolved"), F.lit("{}").alias("item"), F.lit("{}").alias("doc"))
    fetch = lambda d: d.withColumns({"file_name": F.lit(None).cast("string"), "body": F.lit(None).cast("binary"), "reason": F.when(F.col("document_id") % 2 == 1, "gone")})
    good, bad = retry_failed(ledger, fetch)
    return good.select("item_id", "document_id", "resolved").unionByName(bad.select("item_id", "document_id", "resolved"))


QUERIES = {f.__name__: f for f in (
    seed_day_cells, cell_state_counts, item_set_hash, latest_per_key, run_summary, partition_invariant, pending_anti_join, unresolved_failures,
    bigram_frequency, probe_queue, substring_probe_hits, name_probe_hits, span_hits, capped_pages, seed_ranking, yield_decay_stop, running_budget, retry_decisions, backoff_schedule,
    rate_gate_schedule, dry_run_forecast, label_code, outcome_classification, html_extract, grid_reconciliation, asof_attach, log_redaction, slug_path, latin1_form,
    frontier_crawl, retry_outcomes, facet_invariant, search_results, detail_records, record_movements, document_fetches, harvested_seeds, row_tolerance, resume_sweep, gated_run, tolerant_run, rate_gate_cooldown, search_bodies, class_catalogue,
    stored_documents, refused_responses, session_replay, harvested_sweep, item_fields,
)} | {"sweep_cells": sweep_cells}

#: Orders with what their pages say: m the page's case, ok whether all was read, n lines, nd documents.
_LINES = "li AS (SELECT l_orderkey, l_linenumber, min(l_shipdate) AS l_shipdate, min(l_returnflag) AS l_returnflag, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2)"
_RECORDS = f"""{_LINES}, l AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_linenumber % 5 <> 0) AS nd, string_agg(CASE WHEN l_linenumber % 2 = 1 THEN 'legacy/' ELSE 'bornDigital/' END || l_orderkey || l_linenumber || '/Doc ' || l_linenumber || ' (' || l_returnflag || ')/' || l_returnflag, ';' ORDER BY l_linenumber) FILTER (l_linenumber % 5 <> 0) AS docs FROM li GROUP BY l_orderkey),
        r0 AS (SELECT o_orderkey AS k, o_orderkey % 11 AS m, coalesce(n, 0)::INTEGER AS n, coalesce(nd, 0) AS nd, coalesce(docs, '') AS docs, o_orderkey % 13 = 0 AND coalesce(n, 0) > 2 AS late, orders.*, customer.* FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN l ON l_orderkey = o_orderkey),
        r AS (SELECT *, m NOT IN (1, 2, 3, 4, 5) AND NOT late AS ok FROM r0)"""
_FETCHES = f"""WITH {_RECORDS},
        d AS (SELECT k::VARCHAR AS item_id, k::VARCHAR || l_linenumber AS document_id, l_linenumber % 2 = 0 AS born, l_linenumber AS n, (k::VARCHAR || l_linenumber)::BIGINT % 7 AS m, lpad(k::VARCHAR, 7, '0') || '-01.2024.4.05.8300/' || k || l_linenumber AS f
              FROM r JOIN li ON l_orderkey = k WHERE ok AND l_linenumber % 5 <> 0),
        x AS (SELECT *, CASE WHEN m = 1 THEN '503' WHEN born AND m = 2 THEN 'viewer without a submit contract' WHEN born AND m = 4 THEN 'not a file by its content' WHEN born THEN NULL
                     WHEN m = 2 THEN 'notFound' WHEN m = 3 THEN 'no redirect but status 200' WHEN m = 4 THEN 'redirect without location' WHEN m = 5 THEN 'status 429 after the redirect' END AS why FROM d)"""
_HASH = "'sha1:' || sha1(coalesce(string_agg(item_id, chr(10) ORDER BY item_id), ''))"


def _level(cells: str, match: str, depth: int) -> str:
    """One level of the sweep: the first four rows of each cell, by identity."""
    return f"""SELECT c.unit_key, c.window_key, c.facet_value, c.probe, {depth} AS depth, count(h.item_id) AS result_count, {_HASH} AS item_set_hash
        FROM {cells} c LEFT JOIN (SELECT c.unit_key, r.item_id, row_number() OVER (PARTITION BY c.unit_key ORDER BY r.item_id) AS rn FROM {cells} c JOIN r ON {match}) h
        ON h.unit_key = c.unit_key AND h.rn <= 4 GROUP BY ALL"""


def _gated_sql(turns: int = 4) -> str:
    """Turn by turn: grants 500 ms apart, not before the cooldown's end; a 429 starts one unless another lasts."""
    out = """
        WITH RECURSIVE d AS (SELECT unnest(generate_series(min(o_orderdate::DATE), max(o_orderdate::DATE), INTERVAL 1 DAY))::DATE AS day, min(o_orderdate::DATE) AS low FROM orders),
        c AS (SELECT day || '..' || day AS unit_key, CASE WHEN (day - low) % 7 = 0 THEN (day - low) // 7 % 3 + 1 ELSE 0 END AS k FROM d),
        s1 AS (SELECT 0::BIGINT AS now, -1000000::BIGINT AS last, -1000000::BIGINT AS until)"""
    for t in range(1, turns + 1):
        out += f""",
        g{t} AS (SELECT unit_key, k, greatest(now, last + 500, until) + 500 * (row_number() OVER (ORDER BY unit_key) - 1) AS granted_ms FROM c, s{t} WHERE k >= {t - 1 if t > 1 else 0}),
        w{t} AS (SELECT row_number() OVER (ORDER BY granted_ms) AS i, granted_ms FROM g{t} WHERE k >= {t}),
        u{t}(i, until) AS (SELECT 0::BIGINT, until FROM s{t} UNION ALL SELECT w.i, CASE WHEN w.granted_ms >= u.until THEN w.granted_ms + 3000 ELSE u.until END FROM u{t} u JOIN w{t} w ON w.i = u.i + 1),
        s{t + 1} AS (SELECT coalesce(max(granted_ms), 0) AS now, coalesce(max(granted_ms), -1000000) AS last, (SELECT arg_max(until, i) FROM u{t}) AS until FROM g{t})"""
    return out + " " + " UNION ALL ".join(f"SELECT unit_key, granted_ms, 1 AS attempt, CASE WHEN k >= {t} THEN 'transient' ELSE 'ok' END AS outcome, 'complete' AS state FROM g{t}" for t in range(1, turns + 1))


SQL = {
    "sweep_cells": f"""
        WITH r AS (SELECT l_orderkey || '-' || lpad(l_linenumber::VARCHAR, 2, '0') AS item_id, {DAY} AS day, l_returnflag AS facet, p_name AS name FROM lineitem JOIN part ON l_partkey = p_partkey),
        d AS (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM r),
        c0 AS (SELECT day || '..' || day AS unit_key, day || '..' || day AS window_key, NULL::VARCHAR AS facet_value, NULL::VARCHAR AS probe, day FROM d),
        l0 AS ({_level("c0", "r.day = c.day", 0)}),
        c1 AS (SELECT c0.window_key || '|' || f.facet AS unit_key, c0.window_key, f.facet AS facet_value, NULL::VARCHAR AS probe, c0.day FROM c0 JOIN l0 USING (unit_key) CROSS JOIN (SELECT DISTINCT l_returnflag AS facet FROM lineitem) f WHERE l0.result_count >= 4),
        l1 AS ({_level("c1", "r.day = c.day AND r.facet = c.facet_value", 1)}),
        c2 AS (SELECT c1.unit_key || '|' || p.probe AS unit_key, c1.window_key, c1.facet_value, p.probe, c1.day FROM c1 JOIN l1 USING (unit_key) CROSS JOIN (SELECT DISTINCT p_name AS probe FROM part) p WHERE l1.result_count >= 4),
        l2 AS ({_level("c2", "r.day = c.day AND r.facet = c.facet_value AND contains(lower(r.name), lower(c.probe))", 2)})
        SELECT unit_key, window_key, facet_value, probe, depth, CASE WHEN result_count < 4 THEN 'complete' WHEN depth < 2 THEN 'subdivided' ELSE 'truncated' END AS state,
               result_count, result_count >= 4 AS saturated, item_set_hash FROM (SELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2)""",
    "harvested_sweep": f"""
        WITH r AS (SELECT l_orderkey || '-' || lpad(l_linenumber::VARCHAR, 2, '0') AS item_id, {DAY} AS day, l_returnflag AS facet, p_name AS name FROM lineitem JOIN part ON l_partkey = p_partkey),
        d AS (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM r),
        c0 AS (SELECT day || '..' || day AS unit_key, day || '..' || day AS window_key, NULL::VARCHAR AS facet_value, NULL::VARCHAR AS probe, day FROM d),
        h0 AS (SELECT unit_key, item_id, name FROM c0 JOIN r USING (day) QUALIFY row_number() OVER (PARTITION BY unit_key ORDER BY item_id) <= 4),
        l0 AS ({_level("c0", "r.day = c.day", 0)}),
        c1 AS (SELECT c0.window_key || '|' || f.facet AS unit_key, c0.window_key, f.facet AS facet_value, NULL::VARCHAR AS probe, c0.day FROM c0 JOIN l0 USING (unit_key) CROSS JOIN (SELECT DISTINCT l_returnflag AS facet FROM lineitem) f WHERE l0.result_count >= 4),
        h1 AS (SELECT unit_key, item_id, name FROM c1 JOIN r ON r.day = c1.day AND r.facet = c1.facet_value QUALIFY row_number() OVER (PARTITION BY unit_key ORDER BY item_id) <= 4),
        l1 AS ({_level("c1", "r.day = c.day AND r.facet = c.facet_value", 1)}),
        w AS (SELECT lvl, unit_key, item_id, i, t[i] || ' ' || t[i + 1] AS probe FROM (SELECT *, unnest(generate_series(1, len(t) - 1)) AS i FROM (SELECT *, string_split(name, ' ') AS t FROM (SELECT 0 AS lvl, * FROM h0 UNION ALL SELECT 1, * FROM h1)))),
        q AS (SELECT probe FROM (SELECT probe, count(*) AS n, min(ROW(lvl, unit_key, item_id, i)) AS seen FROM w GROUP BY probe) ORDER BY n DESC, seen LIMIT 8),
        c2 AS (SELECT c1.unit_key || '|' || q.probe AS unit_key, c1.window_key, c1.facet_value, q.probe, c1.day FROM c1 JOIN l1 USING (unit_key) CROSS JOIN q WHERE l1.result_count >= 4),
        l2 AS ({_level("c2", "r.day = c.day AND r.facet = c.facet_value AND contains(lower(r.name), lower(c.probe))", 2)})
        SELECT unit_key, window_key, facet_value, probe, depth, CASE WHEN result_count < 4 THEN 'complete' WHEN depth < 2 THEN 'subdivided' ELSE 'truncated' END AS state,
               result_count, item_set_hash FROM (SELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2)""",
    "seed_day_cells": f"SELECT d || '..' || d AS unit_key, d AS day FROM (SELECT strftime(unnest(generate_series(min({ORDER_DAY}), max({ORDER_DAY}), INTERVAL 1 DAY)), '%Y-%m-%d') AS d FROM orders)",
    "cell_state_counts": "SELECT CASE WHEN n < 60 THEN 'complete' ELSE 'truncated' END AS state, n >= 60 AS saturated, count(*) AS cells FROM (SELECT count(*) AS n FROM events GROUP BY CAST(ts AS DATE), event_type) GROUP BY 1, 2",
    "item_set_hash": "SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, 'sha1:' || sha1(string_agg(o_orderkey::VARCHAR, chr(10) ORDER BY o_orderkey::VARCHAR)) AS item_set_hash FROM orders GROUP BY 1",
    "latest_per_key": "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "run_summary": """
        WITH n AS (SELECT CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'purchase' THEN 'subdivided' WHEN value > 50 THEN 'truncated' ELSE 'complete' END AS state, CASE WHEN value > 10 THEN 1 ELSE 0 END AS u
                   FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
        SELECT count(*) FILTER (state = 'complete') AS complete, count(*) FILTER (state = 'truncated') AS truncated, count(*) FILTER (state = 'failed') AS failed, coalesce(sum(u), 0)::BIGINT AS unresolved FROM n""",
    "partition_invariant": """
        WITH o AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS w, o_orderpriority AS p FROM orders),
        a AS (SELECT w, least(count(*), 10) AS n FROM o GROUP BY w), b AS (SELECT w, sum(n)::BIGINT AS s FROM (SELECT w, p, least(count(*), 2) AS n FROM o GROUP BY w, p) GROUP BY w)
        SELECT a.w AS window_key, a.n AS parent_count, b.s AS child_sum, b.s >= a.n AS holds FROM a JOIN b ON a.w = b.w""",
    "pending_anti_join": "SELECT o_orderkey AS unit_key FROM orders WHERE NOT (o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'F')",
    "unresolved_failures": "SELECT user_id AS item_id, event_id % 7 AS document_id, event_id FROM events e WHERE event_type = 'error' AND NOT EXISTS (SELECT 1 FROM events f WHERE f.event_type = 'purchase' AND f.user_id = e.user_id AND f.event_id % 7 = e.event_id % 7)",
    "retry_outcomes": "SELECT DISTINCT user_id AS item_id, event_id % 7 AS document_id, event_id % 7 % 2 = 0 AS resolved FROM events e WHERE event_type = 'error' AND NOT EXISTS (SELECT 1 FROM events f WHERE f.event_type = 'purchase' AND f.user_id = e.user_id AND f.event_id % 7 = e.event_id % 7)",
    "bigram_frequency": "WITH t AS (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part) SELECT w[i] || ' ' || w[i + 1] AS probe, count(*) AS n, min(p_partkey) AS first_seen FROM (SELECT p_partkey, w, unnest(range(1, len(w))) AS i FROM t) GROUP BY 1",
    "probe_queue": "WITH t AS (SELECT string_split(p_name, ' ') AS w FROM part), f AS (SELECT w[i] || ' ' || w[i + 1] AS probe, count(*) AS n FROM (SELECT w, unnest(range(1, len(w))) AS i FROM t) GROUP BY 1) SELECT probe, 0 AS source_rank, n FROM f UNION ALL SELECT probe, 1, 0 FROM (VALUES ('DA SILVA'), ('DOS SANTOS')) d(probe) WHERE probe NOT IN (SELECT probe FROM f)",
    "substring_probe_hits": "WITH p AS (SELECT DISTINCT unnest(string_split(lower(p_name), ' ')) AS probe FROM part) SELECT probe, count(*) AS hits FROM p JOIN part ON contains(lower(p_name), probe) GROUP BY probe",
    "span_hits": f"WITH s AS (SELECT {DAY} AS day, count(*) AS n FROM lineitem GROUP BY 1) SELECT o_orderkey, sum(n)::BIGINT AS lines, count(*) AS days FROM orders JOIN s ON day BETWEEN {ORDER_DAY} AND {ORDER_DAY} + (o_orderkey % 365)::INTEGER GROUP BY 1",
    "capped_pages": "SELECT unit_key, count(*) AS n, sum(event_id)::BIGINT AS ids FROM (SELECT strftime(ts, '%Y-%m-%d') || '|' || event_type AS unit_key, event_id FROM events QUALIFY row_number() OVER (PARTITION BY unit_key ORDER BY event_id) <= 30) GROUP BY unit_key",
    "seed_ranking": "SELECT event_id AS ordinal, CASE WHEN value > 50 THEN 0 ELSE 1 END AS state_rank, CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 ELSE 2147483647 END AS kind_rank FROM events",
    "yield_decay_stop": "WITH s AS (SELECT user_id, row_number() OVER w AS n, sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS 4 PRECEDING) AS h FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) SELECT user_id, min(n) AS stop_at FROM s WHERE h = 0 AND n >= 5 GROUP BY user_id",
    "running_budget": "SELECT l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) <= 2",
    "retry_decisions": """
        WITH e AS (SELECT event_id, event_type AS t, event_id % 7 + 1 AS a, least(1000 * pow(2, event_id % 7), 60000)::BIGINT AS b, CASE WHEN event_id % 3 = 0 THEN 5000 END AS r FROM events)
        SELECT event_id, CASE WHEN t = 'error' AND a > 5 THEN 'stop' WHEN t = 'error' AND event_id % 2 = 0 THEN 'requeue' WHEN t = 'error' THEN 'retry' WHEN t = 'view' AND a <= 1 THEN 'reprime' WHEN t = 'click' AND a <= 2 THEN 'retry' ELSE 'stop' END AS action,
               (CASE WHEN t = 'error' AND a <= 5 THEN coalesce(r, b) WHEN t = 'click' AND a <= 2 THEN b ELSE 0 END)::BIGINT AS delay_ms FROM e""",
    "backoff_schedule": "SELECT event_id, 250.0::DOUBLE AS fixed, (100 + 50 * (event_id % 9))::DOUBLE AS linear, least(1000 * pow(2, event_id % 9), 60000)::DOUBLE AS exponential FROM events",
    "rate_gate_schedule": "WITH e AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS t, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events) SELECT event_id, (max(t - 500 * i) OVER (PARTITION BY user_id ORDER BY event_id) + 500 * i)::BIGINT AS granted FROM e",
    "dry_run_forecast": f"WITH s AS (SELECT greatest(1, least(date_diff('day', min({ORDER_DAY}), max({ORDER_DAY})) + 1, 31)) AS days FROM orders), i AS (SELECT days, least(200, days * 30) AS items FROM s) SELECT days, items, least(10, items) AS documents, days + items + least(10, items) AS requests, ((days + items + least(10, items)) * 0.5)::DOUBLE AS seconds FROM i",
    "label_code": "SELECT p_partkey, p_name AS label, p_size::VARCHAR AS code FROM part",
    "outcome_classification": """
        SELECT o_orderkey::VARCHAR AS key, CASE m WHEN 2 THEN 'unprimedSession' WHEN 3 THEN 'hostDefect' WHEN 4 THEN 'hostDefect' WHEN 5 THEN 'invalidTokenShell' WHEN 1 THEN 'unclassified' ELSE 'validData' END AS validity,
               CASE m WHEN 1 THEN 'transient' WHEN 2 THEN 'sessionExpired' WHEN 3 THEN 'hostDefect' WHEN 4 THEN 'hostDefect' WHEN 5 THEN 'permanentError' ELSE 'ok' END AS detail,
               CASE m WHEN 1 THEN 'transient' WHEN 2 THEN 'sessionExpired' WHEN 3 THEN 'hostDefect' WHEN 4 THEN 'hostDefect' ELSE 'ok' END AS search
        FROM (SELECT o_orderkey, o_orderkey % 11 AS m FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "search_results": """
        SELECT '/s?c=' || o_custkey AS path, lpad(o_orderkey::VARCHAR, 7, '0') || '-01.2024.4.05.8300' AS process_number, 'a' || o_orderkey || 'b' AS token,
               o_orderpriority || ' X Cliente ' || o_custkey || ' e outros (2)' AS parties, o_orderpriority || '|Cliente ' || o_custkey AS names FROM orders WHERE o_orderkey % 7 <> 0""",
    "detail_records": f"""
        WITH {_RECORDS}
        SELECT k::VARCHAR AS key, CASE m WHEN 1 THEN 'transient' WHEN 2 THEN 'sessionExpired' WHEN 3 THEN 'hostDefect' WHEN 4 THEN 'hostDefect' WHEN 5 THEN 'permanentError' ELSE CASE WHEN late THEN 'transient' ELSE 'ok' END END AS kind,
               CASE m WHEN 1 THEN '503' WHEN 2 THEN NULL WHEN 3 THEN 'errorUnexpected.seam with PersistenceException' WHEN 4 THEN 'errorUnexpected.seam with PersistenceException' WHEN 5 THEN 'invalidReference' ELSE CASE WHEN late THEN '429' END END AS reason,
               CASE WHEN ok THEN lpad(k::VARCHAR, 7, '0') || '-01.2024.4.05.8300' END AS process_number, CASE WHEN ok THEN o_orderpriority END AS class_label, CASE WHEN ok THEN k::VARCHAR END AS class_code,
               CASE WHEN ok THEN c_mktsegment || '/7;' || o_orderstatus END AS subjects, CASE WHEN ok THEN c_mktsegment END AS body_name, CASE WHEN ok THEN c_name END AS body_address, CASE WHEN ok THEN strftime(o_orderdate, '%d/%m/%Y') END AS filing_date,
               CASE WHEN ok THEN c_name END AS party, CASE WHEN ok AND k % 2 = 0 THEN c_custkey::VARCHAR END AS cpf, CASE WHEN ok AND k % 2 = 1 THEN c_custkey::VARCHAR END AS cnpj, CASE WHEN ok THEN 'AUTOR' END AS role, CASE WHEN ok THEN 'Ativo' END AS status,
               CASE WHEN ok THEN CASE WHEN k % 3 = 0 THEN 'Clerk ' || o_orderstatus || '/PE/' || k || '/' || c_nationkey ELSE '' END END AS lawyers,
               CASE WHEN ok THEN n ELSE NULL END AS n_movements, CASE WHEN ok THEN docs END AS documents FROM r""",
    "grid_reconciliation": f"""
        {_FETCHES}, y AS (SELECT item_id, count(*) FILTER (why IS NULL) AS n FROM x GROUP BY 1)
        SELECT k::VARCHAR AS key, (r.n + k % 2)::INTEGER AS declared, coalesce(y.n, 0)::INTEGER AS fetched, (nd - coalesce(y.n, 0))::INTEGER AS skipped, (r.n + k % 2 - nd)::INTEGER AS gap FROM r LEFT JOIN y ON y.item_id = k::VARCHAR WHERE ok""",
    "record_movements": f"WITH {_LINES} SELECT l_orderkey::VARCHAR AS key, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber))::INTEGER AS sequence, strftime(l_shipdate, '%Y-%m-%d') || 'T13:00:0' || l_linenumber || '.000Z' AS occurred_at, 'Remessa ' || l_returnflag AS description FROM li JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 11 NOT IN (1, 2, 3, 4, 5)",
    "document_fetches": f"""
        {_FETCHES}
        SELECT item_id, document_id, CASE WHEN born THEN 'bornDigital' ELSE 'legacy' END AS kind, CASE WHEN why IS NULL THEN 'ok' WHEN why = '503' THEN 'transient' WHEN why = 'notFound' THEN 'permanentError' ELSE 'hostDefect' END AS outcome, why AS reason,
               CASE WHEN why IS NULL THEN f || CASE WHEN born THEN '-doc-' || n ELSE '-peticao-' || n END || '.pdf' END AS file_name, CASE WHEN why IS NULL THEN 10 END AS bytes, CASE WHEN born AND m NOT IN (1, 2) THEN document_id END AS fetched_bin_id FROM x""",
    "harvested_seeds": """
        WITH r AS (SELECT o_orderkey AS k, c_custkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 11 NOT IN (1, 2, 3, 4, 5)),
        s AS (SELECT k, 0 AS o, 'lawyerCpf' AS kind, c_nationkey::VARCHAR AS value FROM r WHERE k % 3 = 0 UNION ALL SELECT k, 1, 'partyCpf', c_custkey::VARCHAR FROM r WHERE k % 2 = 0)
        SELECT k::VARCHAR AS key, (row_number() OVER (PARTITION BY k ORDER BY o) - 1)::INTEGER AS position, kind, value FROM s""",
    "row_tolerance": f"""
        WITH {_LINES}, l AS (SELECT l_orderkey AS u, l_linenumber AS n, l_partkey % 23 AS m FROM li), a AS (SELECT DISTINCT u FROM l WHERE m = 0)
        SELECT u AS unit_key, u || '-' || n AS item_id, CASE WHEN m IN (1, 3) THEN 'unresolved' ELSE 'item' END AS what, CASE WHEN m IN (1, 3) THEN 'hostDefect:x y:d' END AS reason FROM l WHERE u NOT IN (SELECT u FROM a)
        UNION ALL SELECT u, NULL, 'aborted', 'transient:503' FROM a""",
    "resume_sweep": """
        WITH d AS (SELECT unnest(generate_series(min(o_orderdate::DATE), max(o_orderdate::DATE), INTERVAL 1 DAY))::DATE AS day FROM orders), o AS (SELECT o_orderkey::VARCHAR AS i, o_orderdate::DATE AS day, o_orderpriority AS f FROM orders),
        a AS (SELECT d.day || '..' || d.day AS unit_key, NULL::VARCHAR AS facet_value, 0 AS depth, d.day, i FROM d LEFT JOIN o ON o.day = d.day),
        b AS (SELECT unit_key, facet_value, depth, day, count(i) AS n, list(i ORDER BY i)[1:5] AS x FROM a GROUP BY ALL),
        e AS (SELECT b.unit_key || '|' || g.f AS unit_key, g.f AS facet_value, 1 AS depth, count(o.i) AS n, list(o.i ORDER BY o.i) FILTER (o.i IS NOT NULL) AS x FROM b CROSS JOIN (SELECT DISTINCT f FROM o) g LEFT JOIN o ON o.day = b.day AND o.f = g.f WHERE b.n >= 5 GROUP BY ALL),
        c AS (SELECT unit_key, facet_value, depth, CASE WHEN n >= 5 THEN 'subdivided' ELSE 'complete' END AS state, least(n, 5) AS result_count, CASE WHEN n = 0 THEN [] ELSE x END AS x FROM b
              UNION ALL SELECT unit_key, facet_value, depth, CASE WHEN n >= 5 THEN 'truncated' ELSE 'complete' END, least(n, 5), coalesce(x[1:5], []) FROM e),
        w AS (SELECT i, arg_min(unit_key, depth) AS unit_key FROM (SELECT unit_key, depth, unnest(x) AS i FROM c) GROUP BY i), t AS (SELECT unit_key, count(*) AS items FROM w GROUP BY unit_key)
        SELECT unit_key, facet_value, depth, state, result_count, 'sha1:' || sha1(array_to_string(x, chr(10))) AS item_set_hash, coalesce(items, 0) AS items FROM c LEFT JOIN t USING (unit_key)""",
    "gated_run": _gated_sql(),
    "tolerant_run": """
        WITH o AS (SELECT o_orderkey AS k, o_orderdate::DATE || '..' || o_orderdate::DATE AS u FROM orders), f AS (SELECT DISTINCT u FROM o WHERE k % 23 = 3), r AS (SELECT * FROM o WHERE u NOT IN (SELECT u FROM f))
        SELECT k::VARCHAR AS item_id, 'item' AS what, CASE WHEN k % 5 <> 0 THEN '' WHEN k % 25 = 0 OR (k % 10 = 0 AND k % 4 > 0) THEN 'd:failed' ELSE 'd:fetched:6' END AS said FROM r WHERE k % 23 <> 1
        UNION ALL SELECT k::VARCHAR, 'row', 'hostDefect:x:d' FROM r WHERE k % 23 = 1 UNION ALL SELECT u, 'cell', 'transient:503' FROM f
        UNION ALL SELECT k::VARCHAR, 'document', CASE WHEN k % 25 = 0 THEN 'gone' ELSE 'transient:503' END FROM r WHERE k % 23 <> 1 AND (k % 25 = 0 OR (k % 10 = 0 AND k % 4 > 0))""",
    "rate_gate_cooldown": "WITH e AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS t, coalesce(sum(CASE WHEN event_type = 'error' THEN 60000 ELSE 500 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM events) SELECT event_id, (max(t - s) OVER (PARTITION BY user_id ORDER BY event_id) + s)::BIGINT AS granted FROM e",
    "stored_documents": f"""
        {_FETCHES}
        SELECT DISTINCT f || CASE WHEN born THEN '-doc-' || n ELSE '-peticao-' || n END || '.pdf' AS file_name, 10 AS bytes, sha1('%PDF-1.4 x') AS sha1 FROM x WHERE why IS NULL""",
    "refused_responses": f"""WITH {_RECORDS}
        SELECT k::VARCHAR AS key, 1 AS page, 503 AS status, '3' AS retry_after FROM r WHERE m = 1
        UNION ALL SELECT k::VARCHAR, 2, 429, NULL FROM r WHERE late""",
    "item_fields": """
        SELECT o_orderkey::VARCHAR AS item_id, strftime(o_orderdate, '%Y-%m-%d') AS unit_key, CASE WHEN m > 1 THEN o_orderstatus END AS label, CASE WHEN m > 1 AND o_orderkey % 3 = 0 THEN o_orderkey END AS code,
               CASE WHEN m = 1 THEN o_orderkey END AS first, CASE WHEN m > 1 THEN c_name END AS party, CASE WHEN m > 1 AND o_orderkey % 2 = 0 THEN c_nationkey END AS nation
        FROM (SELECT *, o_orderkey % 5 AS m FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "session_replay": """
        WITH RECURSIVE o AS (SELECT o_custkey AS session, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS no FROM orders),
        s(session, no, o_orderkey, epoch, replayed) AS (
            SELECT session, -1::BIGINT, 0::BIGINT, 0, false FROM (SELECT DISTINCT session FROM o)
            UNION ALL SELECT o.session, o.no, o.o_orderkey, s.epoch + (o.o_orderkey % 17 = 0 OR s.epoch < o.no // 3)::INTEGER, o.o_orderkey % 17 = 0 OR s.epoch < o.no // 3 FROM s JOIN o ON o.session = s.session AND o.no = s.no + 1)
        SELECT session, no::INTEGER AS no, o_orderkey, epoch, 'v' || epoch AS view_state, replayed, CASE WHEN o_orderkey % 17 = 0 OR epoch < no // 3 THEN 'sessionExpired' ELSE 'ok' END AS outcome FROM s WHERE no >= 0""",
    "search_bodies": """
        SELECT c_custkey, p::INTEGER AS position, n AS name, CASE WHEN n = 'j9%3AnomeParteInput' THEN replace(c_name, '#', '%23') WHEN n = 'j9%3AclasseJudicial' AND c_custkey % 2 = 0 THEN 'A%E7%E3o+%26%238211%3B+%E3' ELSE v END AS value
        FROM customer, (VALUES (0, 'AJAXREQUEST', '_viewRoot'), (1, 'j9%3AnumProcesso', ''), (2, 'j9%3AnomeParteInput', ''), (3, 'j9%3AnomeAdv', ''), (4, 'j9%3AclasseJudicial', ''), (5, 'j9%3AdocumentoParte', ''), (6, 'j9%3AestadoComboOAB', ''),
             (7, 'j9%3AdataAutuacaoInicio', '01%2F02%2F2024'), (8, 'j9%3AdataAutuacaoFim', '02%2F02%2F2024'), (9, 'fPP', 'fPP'), (10, 'javax.faces.ViewState', 'j_id1'), (11, 'j9%3Ago', 'j9%3Ago'), (12, 'AJAX%3AEVENTS_COUNT', '1')) x(p, n, v)""",
    "class_catalogue": "SELECT p_type AS label, CASE WHEN p_size > 25 THEN p_size::VARCHAR END AS code FROM (SELECT DISTINCT p_type, p_size FROM part)",
    "facet_invariant": """
        WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS w, o_orderpriority AS p, o_orderstatus AS s, right(o_custkey::VARCHAR, 1) AS c FROM orders),
        a AS (SELECT w, least(count(*), 30) AS n FROM o GROUP BY w), b AS (SELECT w, p, least(count(*), 20) AS n FROM o GROUP BY w, p), d AS (SELECT w, p, sum(n) AS n FROM (SELECT w, p, least(count(*), 6) AS n FROM o GROUP BY w, p, s UNION ALL SELECT w, p, 1 FROM o GROUP BY w, p, c) GROUP BY w, p)
        SELECT a.w AS window_key, NULL AS facet_value, a.n AS parent_count, t.n::BIGINT AS child_sum, t.n >= a.n AS holds FROM a JOIN (SELECT w, sum(n) AS n FROM b GROUP BY w) t USING (w) UNION ALL SELECT w, p, b.n, d.n::BIGINT, d.n >= b.n FROM b JOIN d USING (w, p)""",
    "html_extract": """
        WITH t AS (SELECT page_id, html, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS t FROM pages)
        SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\\s+', ' ', 'g')) AS title, len(regexp_extract_all(html, '(?i)<a\\s[^>]*href')) AS n_links FROM t""",
    "slug_path": "SELECT p_partkey, p_partkey || '/d1-' || left(regexp_replace(lower(p_name), '[^a-z0-9._-]+', '-', 'g'), 60) || '.pdf' AS path FROM part",
    "latin1_form": """
        WITH e AS (SELECT doc_id, array_to_string(list_transform(string_split(text, ''), lambda c: CASE WHEN c = ' ' THEN '+' WHEN regexp_full_match(c, '[A-Za-z0-9*._-]') THEN c WHEN unicode(c) <= 255 THEN printf('%%%02X', unicode(c)) ELSE '%26%23' || unicode(c) || '%3B' END), '') AS t FROM documents)
        SELECT doc_id, length(t)::BIGINT AS encoded_chars, sha256(t) AS sha256 FROM e""",
    "name_probe_hits": "WITH p AS (SELECT lower(p_name) AS n, count(*) AS c FROM part GROUP BY 1) SELECT a.n AS probe, sum(b.c)::BIGINT AS hits FROM p a JOIN p b ON contains(b.n, a.n) GROUP BY 1",
    "asof_attach": "SELECT conv_id, turn, user_turn FROM (SELECT conv_id, turn, role, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS user_turn FROM conversations) WHERE role = 'assistant'",
    "log_redaction": "SELECT event_id, '[REDACTED]' AS cpf, event_type AS kind FROM events",
}


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweep_cells(spark, sf_dir, cap=2)
