"""The warehouse's streaming jobs, one query each, coupled only by topics.

Every job reads topics, applies operators and writes a topic or a summary table. Joins with
dimensions run inside foreachBatch, where each micro-batch reads the dimension as it is then, and
where AQE plans the join from the sizes it meets.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart import schemas
from tidemart.functions.json_rows import parse_topic, to_topic
from tidemart.operators import keyword_stats as keyword_ops
from tidemart.operators import logs as log_ops
from tidemart.operators import orders as order_ops
from tidemart.operators import product_stats as product_ops
from tidemart.operators import province_stats as province_ops
from tidemart.operators import routing
from tidemart.operators import visitor_stats as visitor_ops
from tidemart.operators import visits
from tidemart.operators.dims import product_dimension
from tidemart.operators.payments import join_payments, untimed_payments
from tidemart.sources.batches import BatchTable
from tidemart.sources.changes import normalise_changes, read_envelopes
from tidemart.sources.dimensions import DimensionStore
from tidemart.sources.summaries import SummarySink
from tidemart.sources.topics import Topics, each_batch, start
from tidemart.streaming.first_visits import FirstVisits
from tidemart.streaming.jump_timers import timed_jumps
from tidemart.streaming.late_rows import Ledger, late, late_counts

TOPICS = {
    "raw_log": "ods_base_log", "raw_db": "ods_base_db", "rules": "table_process",
    "page": "dwd_page_log", "start": "dwd_start_log", "display": "dwd_display_log",
    "dirty": "dwd_dirty_log", "dirty_db": "ods_dirty_db", "unrouted": "ods_unrouted_db",
    "order_info": "dwd_order_info", "order_detail": "dwd_order_detail",
    "payment": "dwd_payment_info", "favor": "dwd_favor_info", "cart": "dwd_cart_info",
    "refund": "dwd_order_refund_info", "comment": "dwd_comment_info",
    "unique_visit": "dwm_unique_visit", "user_jump": "dwm_user_jump_detail",
    "order_wide": "dwm_order_wide", "payment_wide": "dwm_payment_wide",
    "untimed_payment": "dwm_untimed_payment", "late_page": "dwm_late_page",
}
DIMENSIONS = {
    "user": "dim_user_info", "province": "dim_base_province", "sku": "dim_sku_info",
    "spu": "dim_spu_info", "trademark": "dim_base_trademark", "category3": "dim_base_category3",
}
SUMMARIES = {
    "visitor": "visitor_stats_2021", "product": "product_stats_2021",
    "province": "province_stats_2021", "keyword": "keyword_stats_2021",
    "late": "late_pages_2021",
}


@dataclass
class Warehouse:
    """Settings shared by the jobs, and one method per job.

    `salts` spreads the details of one order over that many state partitions in the
    stream-stream joins, and the pages of one device and day in the unique visits. With `timers` a
    bounce is told at its own timeout, by Python workers; without, by windows alone, two cells later. `lag` is how far a topic may run behind others that feed the same
    summary, and, unless `delay` says otherwise, how far out of order the rows of joined topics may
    come: a row reaches it through one to three micro-batches of other jobs, and one that comes
    after the watermark is lost. Stored changes and first visits are
    folded into a new base after every `fold_every` micro-batches. `once` drains the topics and stops; otherwise queries keep
    running.
    """

    spark: SparkSession
    topics: Topics
    dimensions: DimensionStore
    summaries: SummarySink
    state: str
    salts: int = 4
    width: str = "10 seconds"
    timeout: str = "10 seconds"
    lag: str = "5 minutes"
    delay: str | None = None
    timers: bool = True
    rules_as_of: bool = False
    day_start: str = "0 hours"
    on_delete: str = "ignore"
    as_of: str | None = None
    once: bool = False
    interval: str | None = None
    fold_every: int = 100
    names: dict[str, str] = field(default_factory=lambda: dict(TOPICS))

    # -- plumbing -----------------------------------------------------------
    def _read(self, topic: str) -> DataFrame:
        return self.topics.read(self.spark, self.names[topic])

    def _rows(self, topic: str, schema, *columns: str) -> DataFrame:
        return parse_topic(self._read(topic).select("value", *columns), schema)

    def _start(self, writer, job: str) -> StreamingQuery:
        return start(writer, f"{self.state.rstrip('/')}/checkpoints", job, self.once, self.interval)

    def _to_topic(self, rows: DataFrame, topic: str, job: str) -> StreamingQuery:
        return self._start(self.topics.write(to_topic(rows), self.names[topic]), job)

    def _to_summary(self, rows: DataFrame, summary: str, columns: list[str],
                    job: str) -> StreamingQuery:
        def work(batch: DataFrame, batch_id: int) -> None:
            self.summaries.put(batch, SUMMARIES[summary], columns, batch_id)
        return self._start(each_batch(rows, work), job)

    def _folds(self, batch_id: int) -> bool:
        return batch_id % self.fold_every == self.fold_every - 1

    def _dimension(self, name: str) -> DataFrame:
        return self.dimensions.read(DIMENSIONS[name])

    def _products(self) -> DataFrame:
        return product_dimension(*[self._dimension(d)
                                   for d in ("sku", "spu", "trademark", "category3")])

    # -- raw and detail layers ----------------------------------------------
    def capture_changes(self, records: DataFrame) -> StreamingQuery:
        """Capture-tool records (topic, value, seq) to the raw change topic."""
        changes = normalise_changes(read_envelopes(records))
        return self._to_topic(changes, "raw_db", "capture_changes")

    def split_logs(self) -> StreamingQuery:
        """Raw lines to the page, start, display and dirty topics, with repaired flags."""
        visits_seen = FirstVisits(self.spark, f"{self.state.rstrip('/')}/first_visits")

        def work(batch: DataFrame, batch_id: int) -> None:
            # Rows of one file share a place; the row number tells them apart. A line is checked
            # once and parsed once: all that follows reads what is kept of it.
            checked = log_ops.checked_lines(batch.withColumn(
                "row", F.monotonically_increasing_id()).withColumn("line", F.col("value"))).persist()
            parsed = log_ops.parse_checked(checked).persist()
            logs = None
            try:
                logs = visits_seen.repair(parsed, batch_id, ("ts", "seq", "row")).persist()
                pages = log_ops.page_logs(logs)
                branches = {
                    "page": log_ops.payload(pages),
                    "start": log_ops.payload(log_ops.start_logs(logs)),
                    "display": log_ops.display_logs(pages).select(
                        F.to_json("display").alias("value")),
                    "dirty": checked.where("NOT good").select("value")}
                for name, lines in branches.items():
                    self.topics.put(lines, self.names[name], batch_id)
                if self._folds(batch_id):
                    visits_seen.compact()
            finally:
                for kept in (logs, parsed, checked):
                    if kept is not None:
                        kept.unpersist()
        return self._start(each_batch(self._read("raw_log"), work), "split_logs")

    def route_changes(self, rule_changes) -> StreamingQuery:
        """Raw changes to fact topics and dimension tables; bad lines and changes without a rule to
        topics of their own.

        `rule_changes` is a callable that gives the changes of the rule table so far; it is
        called for every micro-batch, so a new rule counts from the next batch on. The rules of a
        batch are written down before they are used: a replay routes by the same ones. With
        `rules_as_of` their versions are, and each change takes the version of its own number.
        """
        as_of = self.rules_as_of
        noted = BatchTable(self.spark, f"{self.state.rstrip('/')}/{'rule_versions' if as_of else 'rules'}",
                           schemas.RULE_VERSION if as_of else schemas.dimension(schemas.RULE_COLUMNS))
        known = routing.rule_versions if as_of else routing.latest_rules
        route, unrouted = (routing.route_as_of, routing.unrouted_as_of) if as_of else (
            routing.route, routing.unrouted)

        def work(batch: DataFrame, batch_id: int) -> None:
            if not noted.has(batch_id):
                noted.append(known(rule_changes()), batch_id)
            rules = noted.batches(after=batch_id - 1, before=batch_id + 1)
            self.dimensions.create_missing(rules)
            changes = routing.nonempty_changes(routing.parse_changes(batch)).persist()
            routed = route(changes, rules).persist()
            try:
                lines = routing.fact_payload(routing.fact_branch(routed))
                for name, left in (("dirty_db", log_ops.dirty_lines(batch)),
                                   ("unrouted", to_topic(unrouted(changes, rules)))):
                    lines = lines.unionByName(
                        left.select(F.lit(self.names[name]).alias("topic"), "value"))
                self.topics.put_routed(lines, batch_id)
                self.dimensions.put(routing.dimension_branch(routed), batch_id, self.on_delete)
            finally:
                routed.unpersist()
                changes.unpersist()
            if self._folds(batch_id):
                for table in self.dimensions.tables():
                    self.dimensions.compact(table)
            noted.forget(before=batch_id)
        return self._start(each_batch(self._read("raw_db"), work), "route_changes")

    # -- wide layer -----------------------------------------------------------
    def unique_visits(self) -> StreamingQuery:
        pages = self._rows("page", schemas.LOG).drop("start")
        first = visits.unique_visitors(pages, day_start=self.day_start, delay=self.lag, salts=self.salts)
        return self._to_topic(first, "unique_visit", "unique_visits")

    def user_jumps(self) -> StreamingQuery:
        pages = self._rows("page", schemas.LOG).drop("start")
        jumps = timed_jumps if self.timers else visits.user_jumps
        return self._to_topic(jumps(pages, self.timeout), "user_jump", "user_jumps")

    def order_wide(self) -> StreamingQuery:
        joined = order_ops.join_order_details(
            self._rows("order_info", schemas.ORDER_INFO),
            self._rows("order_detail", schemas.ORDER_DETAIL), delay=self.delay or self.lag,
            salts=self.salts)
        as_of = F.lit(self.as_of).cast("date") if self.as_of else None

        def work(batch: DataFrame, batch_id: int) -> None:
            wide = order_ops.enrich_orders(batch, self._dimension("user"),
                                           self._dimension("province"), self._products(), as_of)
            self.topics.put(to_topic(wide), self.names["order_wide"], batch_id)
        return self._start(each_batch(joined, work), "order_wide")

    def untimed_payments(self) -> StreamingQuery:
        """Payments without a readable time, which the join leaves out, to a topic of their own."""
        return self._to_topic(untimed_payments(self._rows("payment", schemas.PAYMENT_INFO)),
                              "untimed_payment", "untimed_payments")

    def payment_wide(self) -> StreamingQuery:
        joined = join_payments(self._rows("payment", schemas.PAYMENT_INFO),
                               self._rows("order_wide", schemas.ORDER_WIDE),
                               delay=self.delay or self.lag, salts=self.salts)
        return self._to_topic(joined, "payment_wide", "payment_wide")

    # -- summary layer ----------------------------------------------------------
    def visitor_stats(self) -> StreamingQuery:
        stats = visitor_ops.visitor_stats(
            self._rows("page", schemas.LOG), self._rows("unique_visit", schemas.LOG),
            self._rows("user_jump", schemas.LOG), self.width, self.lag)
        return self._to_summary(stats, "visitor", schemas.VISITOR_STATS_COLUMNS, "visitor_stats")

    def late_pages(self) -> StreamingQuery:
        """Pages that come too late for the windows of `visitor_stats`, to a topic of their own, and
        their number by window to a summary table.

        A query of its own: with `once` and the same files to a batch it meets the batches that the
        statistics meet, and otherwise its own ones.
        """
        ledger = Ledger(self.spark, f"{self.state.rstrip('/')}/late_pages", self.lag)

        def work(batch: DataFrame, batch_id: int) -> None:
            rows = batch.persist()
            try:
                left = late(rows, ledger.watermark(batch_id), self.width)
                self.topics.put(to_topic(left.drop("seq")), self.names["late_page"], batch_id)
                self.summaries.put(late_counts(left, self.width), SUMMARIES["late"],
                                   schemas.LATE_COLUMNS, batch_id)
                ledger.note(rows, batch_id)
            finally:
                rows.unpersist()
        return self._start(each_batch(self._rows("page", schemas.LOG, "seq"), work), "late_pages")

    def product_stats(self) -> StreamingQuery:
        measures = product_ops.product_measures(
            self._rows("page", schemas.LOG), self._rows("favor", schemas.FAVOR_INFO),
            self._rows("cart", schemas.CART_INFO), self._rows("order_wide", schemas.ORDER_WIDE),
            self._rows("payment_wide", schemas.PAYMENT_WIDE),
            self._rows("refund", schemas.REFUND_INFO), self._rows("comment", schemas.COMMENT_INFO))
        orders = product_ops.per_order(measures, self.width, self.lag)

        def work(batch: DataFrame, batch_id: int) -> None:
            rows = product_ops.enrich_product_stats(product_ops.counted_orders(batch), self._products())
            self.summaries.put(rows, SUMMARIES["product"], schemas.PRODUCT_STATS_COLUMNS, batch_id)
        return self._start(each_batch(orders, work), "product_stats")

    def province_stats(self) -> StreamingQuery:
        stats = province_ops.province_stats(self._rows("order_wide", schemas.ORDER_WIDE), self.width,
                                            self.lag)
        columns = schemas.PROVINCE_STATS_COLUMNS

        def work(batch: DataFrame, batch_id: int) -> None:
            self.summaries.put(province_ops.with_clock(batch, columns), SUMMARIES["province"],
                               columns, batch_id)
        return self._start(each_batch(stats, work), "province_stats")

    def keyword_stats(self, dictionary: DataFrame | None = None) -> StreamingQuery:
        search = keyword_ops.search_rows(self._rows("page", schemas.LOG_MAPS), self.lag)
        stats = keyword_ops.keyword_stats(search, self.width, dictionary=dictionary)
        columns = schemas.KEYWORD_STATS_COLUMNS

        def work(batch: DataFrame, batch_id: int) -> None:
            self.summaries.put(province_ops.with_clock(batch, columns), SUMMARIES["keyword"],
                               columns, batch_id)
        return self._start(each_batch(stats, work), "keyword_stats")
