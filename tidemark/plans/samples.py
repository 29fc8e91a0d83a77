"""The layers over the sample tables, without stored tables in between.

The registered queries and the tests use these: ``Shop`` holds one state of the
shop (everything at once, or after the first or second delivery, or after corrections of the first).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dimensions import build_static_dimensions, distinct_values
from tidemark.operators.merge import merge_upsert
from tidemark.operators.staging import stage
from tidemark.plans import bronze, dims, facts, incremental, silver
from tidemark.plans.pipeline import FULL, SINCE
from tidemark.sources.datasets import DATASETS, dataset
from tidemark.sources.samples import Samples

FIRST_DATE, LAST_DATE = "2024-01-15", "2024-01-31"
FIRST_TS, MIDDLE_TS, LAST_TS = "2024-01-15 00:00:00", "2024-01-20 00:00:00", "2024-01-31 00:00:00"


class Shop:
    """Silver frames and Gold tables derived from the sample tables in a folder.

    ``delivery`` None takes all rows in one load; 1 and 2 replay two deliveries; 3 corrects rows of the
    first one and brings no snapshot. With
    ``stored``, Silver tables are written before they are used, as in a lakehouse:
    Gold reads most of them several times. ``reads`` names the columns to write of the data sets it lists.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        delivery: int | None = None,
        stored: bool = False,
        samples: Samples | None = None,
        reads: Mapping[str, Sequence[str]] | None = None,
    ):
        self.spark, self.folder, self.delivery, self.stored = spark, folder, delivery, stored
        self.reads = reads or {}
        self.samples = samples or Samples(spark, folder)
        self.process_date = FIRST_DATE if delivery == 1 else LAST_DATE
        self.process_ts = FIRST_TS if delivery == 1 else LAST_TS
        self._silver: dict[str, DataFrame] = {}
        self._days: dict[str, DataFrame] = {}
        self._dims: dict[str, DataFrame] = {}

    @cached_property
    def previous(self) -> Shop | None:
        if self.delivery not in (2, 3):
            return None
        return Shop(self.spark, self.folder, 1, self.stored, self.samples, self.reads)

    def source(self, name: str) -> DataFrame:
        return self.samples.source(name, self.delivery)

    def bronze(self, name: str) -> DataFrame:
        return bronze.to_bronze(self.source(name), name, self.process_date)

    def silver_batch(self, name: str) -> DataFrame:
        """Silver rows of this delivery alone."""
        return silver.to_silver(self.bronze(name), name, self.process_date)

    def silver(self, name: str) -> DataFrame:
        """The Silver table after this delivery."""
        if name not in self._silver:
            if self.delivery == 3 and dataset(name).snapshot:
                return self.previous.silver(name)
            batch = self.silver_batch(name)
            if name in self.reads:
                batch = batch.select(*self.reads[name])
            if self.stored:
                batch = stage(batch, f"silver-{name}")
            if self.previous and not dataset(name).snapshot:
                # Both parts are written; readers take the columns and days of either that they need.
                batch = merge_upsert(
                    self.previous.silver(name), batch, dataset(name).keys, check_unique=False
                )
            self._silver[name] = batch
        return self._silver[name]

    def usable(self, name: str, within: DataFrame | None = None) -> DataFrame:
        """Valid rows. Those whose keys are not ``within`` a part of the key may be left out."""
        if within is None or self.stored or self.previous or name in self._silver:
            return incremental.usable(self.silver(name), name)
        # All versions of a key are within or none is, so fewer rows have to be told apart.
        rows = self.bronze(name).join(within, within.columns, "left_semi")
        return incremental.usable(silver.to_silver(rows, name, self.process_date), name)

    def dims(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """Dimension tables after this delivery, written out, built at most once."""
        if self.delivery == 3:
            return self.previous.dims(names)
        names = set(names)
        wanted = set(names)
        if "dim_product" in wanted:
            wanted.add("dim_category")
        missing = wanted - set(self._dims)
        static = [n for n in dims.STATIC_DIMENSIONS if n in missing]
        if self.previous:
            held = self.previous.dims(missing)
            for n in static:
                frame = self.silver(dims.STATIC_DIMENSIONS[n][0])
                self._dims[n] = dims.static_dimension(n, frame, held[n])
        else:
            held = {}
            self._dims.update(self._first_static(static))
        if "dim_date" in missing:
            self._dims["dim_date"] = dims.dim_date(self.spark)
        if "dim_customer" in missing:
            self._dims["dim_customer"] = dims.dim_customer(
                self.silver("customers"), self.process_date, self.process_ts, held.get("dim_customer")
            )
        if "dim_product" in missing:
            self._dims["dim_product"] = dims.dim_product(
                self.silver("products"),
                self._dims["dim_category"],
                self.process_ts,
                held.get("dim_product"),
            )
        for n in missing - {"dim_date"}:
            # Read from written tables, facts know how large they are.
            self._dims[n] = stage(self._dims[n], n)
        return {n: self._dims[n] for n in names}

    def _first_static(self, names: list[str]) -> dict[str, DataFrame]:
        """Static dimensions of a first load: one scan per Silver table they come from."""
        by_table: dict[str, dict[str, str]] = {}
        for n in names:
            table, column, _, _ = dims.STATIC_DIMENSIONS[n]
            by_table.setdefault(table, {})[n] = column
        if not by_table:
            return {}
        values = [distinct_values(self.silver(t), columns) for t, columns in by_table.items()]
        contracts = {n: (spec[3], spec[2]) for n, spec in dims.STATIC_DIMENSIONS.items() if n in names}
        return build_static_dimensions(reduce(DataFrame.unionByName, values), contracts)

    def fact_rows(self, name: str, dimensions: Iterable[str] | None = None) -> DataFrame:
        """Unnumbered rows of a full load; ``dimensions`` names those that matter."""
        return FULL[name](self.usable, self.dims(dimensions or facts.FACTS[name].dimensions))

    def fact(self, name: str) -> DataFrame:
        """A fact table after a full load."""
        if self.stored:
            return facts.numbered_first(name, FULL[name], self.usable, self.dims(facts.FACTS[name].dimensions))
        return facts.numbered(name, self.fact_rows(name))

    def dated(self, name: str) -> DataFrame:
        return incremental.with_date(self.silver(name), name)

    def fact_delta(self, name: str, held: DataFrame) -> incremental.Delta:
        """Unnumbered rows of the increment since the first delivery, which gave ``held``."""
        marks = dict.fromkeys(DATASETS, FIRST_DATE)
        return SINCE[name](self.dated, self.dims(facts.FACTS[name].dimensions), marks, held)

    def days_batch(self, name: str) -> DataFrame:
        """Key and processing date of this delivery's Silver rows, written once: the upsert and the marks read it."""
        if name not in self._days:
            sent = bronze.valid_records(self.bronze(name)).select(*dataset(name).keys).distinct()
            self._days[name] = stage(
                sent.withColumn("processed_date", F.lit(self.process_date).cast("date")), f"days-{name}"
            )
        return self._days[name]

    def silver_days(self, name: str) -> DataFrame:
        """Key and processing date of every row of the Silver table: what marks need of it."""
        if not self.previous or dataset(name).snapshot:
            return self.previous.silver_days(name) if self.delivery == 3 else self.days_batch(name)
        held = self.previous.silver_days(name)
        return merge_upsert(held, self.days_batch(name), dataset(name).keys, check_unique=False)

    def silver_days_tables(self) -> dict[str, DataFrame]:
        return {name: self.silver_days(name) for name in DATASETS}
