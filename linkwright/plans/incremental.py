"""Incremental linking: relink after a delta without redoing what is known.

A link store is a folder:

* ``order`` -- the token order of the fuzzy keys, written once. Keys of all versions go by it.
* ``accounts/version=<v>`` -- one version per delta: the account rows, the distinct cleaned names with their
  smallest ``Id``, and the names' candidate keys, bucketed and sorted by key (by name). A new firm's keys are
  shuffled to the buckets; the index side of that join is read in place, without exchange or sort.
* ``state`` -- published versions: every firm seen, with its best account by name and by address so far.

A run compares new firms with all account versions, and known firms with the new version alone. A best match
is the greatest by (similarity, smallest ``Id``), which merges over versions, so with ``relink="best"`` the
crosswalk equals that of a full run over everything seen. ``relink="unmatched"`` compares only known firms
without a link with the new accounts: a link once made is never replaced, as in the reference.

Account rows whose ``Id`` is already in the store and firms whose ``rec_id`` is in the state are not taken
again. Rows with a NULL id are left out, as they can neither be linked nor found again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_account_name
from ..operators.fuzzy_join import met, name_keys, scored_pairs, token_order
from ..operators.topk import best_per_group
from ..sources.publish import current_version, publish, read_current, set_current
from .link import stage_firms
from .matchers import NAME_THRESHOLD, match_by_address

ACCOUNT_COLUMNS = ("Id", "Account_Name", "Billing_Code", "Billing_Street")
FIRM_COLUMNS = ("rec_id", "name", "kuerzel", "plz", "strasse")
#: What is known of a firm besides its columns.
BEST = "name_id string, name_sim double, address_id string, address_sim double"


@dataclass
class LinkStore:
    """A link store at ``base`` (a folder all executors share); ``buckets`` of the key index, at least the
    session's shuffle partitions, so that a join keeps them."""

    spark: SparkSession
    base: str
    threshold: float = NAME_THRESHOLD
    buckets: int | None = None
    _tables: dict[tuple[str, int], str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.base = self.base.rstrip("/")
        if self.buckets is None:
            self.buckets = max(8, int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    # -- account versions

    def versions(self) -> list[int]:
        last = current_version(self.spark, f"{self.base}/accounts")
        return list(range(1, int(last) + 1)) if last else []

    def _part(self, kind: str, version: int) -> str:
        return f"{self.base}/{kind}/version={version}"

    def _accounts(self, versions: list[int]) -> DataFrame | None:
        paths = [self._part("accounts", v) for v in versions]
        return self.spark.read.parquet(*paths).select(*ACCOUNT_COLUMNS) if paths else None

    def _bucketed(self, kind: str, version: int, by: str, write: DataFrame | None = None) -> DataFrame:
        """A table of one version, bucketed by ``by``. Bucketing is known to the session's catalog only, so a
        session that did not write the table registers its files first."""
        name = self._tables.get((kind, version))
        if name is None:
            name = self._tables[kind, version] = f"link_{kind}_{version}_{uuid.uuid4().hex}"
            path = self._part(kind, version)
            if write is not None:
                (write.repartition(self.buckets, by).write.mode("overwrite").format("parquet").option("path", path)
                 .bucketBy(self.buckets, by).sortBy(by).saveAsTable(name))
            else:
                columns = self.spark.read.parquet(path).schema
                fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
                self.spark.sql(f"create table {name} ({fields}) using parquet clustered by ({by}) sorted by ({by}) "
                               f"into {self.buckets} buckets location '{path}'")
        return self.spark.table(name)

    def names(self, version: int) -> DataFrame:
        """(name, Id) of a version: distinct cleaned names and their smallest account."""
        return self._bucketed("names", version, "name")

    def keys(self, version: int) -> DataFrame:
        """(b_id, key, ..) of a version: candidate keys of its names."""
        return self._bucketed("keys", version, "key")

    def add_accounts(self, accounts: DataFrame) -> int | None:
        """Index the accounts not yet in the store as a new version; None without any."""
        new = accounts.select(F.col("Id").cast("string").alias("Id"), *ACCOUNT_COLUMNS[1:]).where("Id is not null")
        old = self._accounts(self.versions())
        if old is not None:
            new = new.join(old.select("Id"), "Id", "left_anti")
        version = len(self.versions()) + 1
        new.write.mode("overwrite").parquet(self._part("accounts", version))
        new = self._accounts([version])
        if new.isEmpty():
            return None
        names = (new.select(clean_account_name("Account_Name").alias("name"), "Id").where("name is not null")
                 .groupBy("name").agg(F.min("Id").alias("Id")))
        names = self._bucketed("names", version, "name", names)
        order = f"{self.base}/order"
        if version == 1:
            token_order(names.select("name")).write.mode("overwrite").parquet(order)
        keys = name_keys(names.select("name"), self.spark.read.parquet(order), self.threshold, False)
        self._bucketed("keys", version, "key", keys.withColumnRenamed("id", "b_id"))
        # the version counts from here on: what a broken run wrote is written anew by the next
        set_current(self.spark, f"{self.base}/accounts", str(version))
        return version

    # -- matches

    def name_matches(self, firms: DataFrame, versions: list[int]) -> DataFrame:
        """(mc, name_id, name_sim): best account of the given versions per cleaned firm name ``mc``; names whose
        ``name_sim`` so far is 1 are compared with equal names alone."""
        firm_names = firms.select(F.col("mc").alias("name")).where("name is not null").distinct()
        # an equal key cannot be beaten (no other key scores 1, and '' pairs with '' alone), so names that
        # have one, here or from versions before, meet equal names only: a smaller Id may be among them
        open_names = firms.where("name_sim is null or name_sim < 1").select(F.col("mc").alias("name")).where("name <> ''").distinct()
        for v in versions:
            open_names = open_names.join(self.names(v).select("name"), "name", "left_anti")
        # written once: the keys are read by a join per version, whose plans stay short that way
        path = f"{self.base}/work/{uuid.uuid4().hex}/open-names"
        open_names.write.parquet(path)
        open_names = self.spark.read.parquet(path)
        order = self.spark.read.parquet(f"{self.base}/order")
        keys = name_keys(open_names, order, self.threshold, True).withColumnRenamed("id", "a_id")
        found = None
        for v in versions:
            names = self.names(v)
            equal = firm_names.join(names, "name").select(
                F.col("name").alias("mc"), "Id", F.when(F.col("name") == "", 0.0).otherwise(1.0).alias("sim"))
            pairs = scored_pairs(self.candidates(keys, v), firm_names, names, self.threshold)
            near = pairs.join(names, F.col("b") == F.col("name")).select(F.col("a").alias("mc"), "Id", "sim")
            both = equal.unionByName(near)
            found = both if found is None else found.unionByName(both)
        best = best_per_group(found, ["mc"], [("sim", True), ("Id", False)])
        return best.select("mc", F.col("Id").alias("name_id"), F.col("sim").alias("name_sim"))

    def candidates(self, keys: DataFrame, version: int) -> DataFrame:
        """Firm keys (a_id, key, ..) against the index of a version; only the firms' side is shuffled."""
        return met(keys, self.keys(version))

    # -- state

    def state(self) -> DataFrame | None:
        """Firms seen with their best matches; None before the first run."""
        if current_version(self.spark, f"{self.base}/state") is None:
            return None
        return read_current(self.spark, f"{self.base}/state")

    def crosswalk(self) -> DataFrame:
        """(rec_id, id_zoho): by name, else by address, else NULL."""
        return self.state().select("rec_id", F.coalesce("name_id", "address_id").alias("id_zoho"))


def _better(rows: DataFrame, kind: str, found: DataFrame, on: str) -> DataFrame:
    """``rows`` with ``<kind>_id`` and ``<kind>_sim`` replaced where ``found`` has a better one."""
    was_id, was_sim = F.col(f"{kind}_id"), F.col(f"{kind}_sim")
    new = found.select(F.col(on).alias("_on"), F.col(f"{kind}_id").alias("_id"), F.col(f"{kind}_sim").alias("_sim"))
    joined = rows.join(new, F.col(on) == F.col("_on"), "left")
    better = F.col("_id").isNotNull() & (was_id.isNull() | (F.col("_sim") > was_sim)
                                         | ((F.col("_sim") == was_sim) & (F.col("_id") < was_id)))
    return joined.withColumns({f"{kind}_id": F.when(better, F.col("_id")).otherwise(was_id),
                               f"{kind}_sim": F.when(better, F.col("_sim")).otherwise(was_sim)}).drop("_on", "_id", "_sim")


def link_delta(store: LinkStore, firms: DataFrame, accounts: DataFrame, relink: str = "best") -> DataFrame:
    """Take new firms and accounts into the store and return the crosswalk of everything seen.

    ``relink``: ``best`` also lets known links give way to better new accounts (equal to a full run),
    ``unmatched`` keeps every link. Empty deltas change nothing. The new state is published last, in one
    rename; a run that breaks off is repeated with the same delta.
    """
    if relink not in ("best", "unmatched"):
        raise ValueError(f"relink must be best or unmatched, not {relink!r}")
    spark = store.spark
    added = store.add_accounts(accounts)
    versions = store.versions()
    blank = [F.lit(None).cast(t.split()[1]).alias(t.split()[0]) for t in BEST.split(", ")]
    new = stage_firms(firms.select(*FIRM_COLUMNS)).where("rec_id is not null").select(*FIRM_COLUMNS, *blank)
    known = store.state()
    if known is not None:
        new = new.join(known.select("rec_id"), "rec_id", "left_anti").select(*new.columns)
    path = f"{store.base}/work/{uuid.uuid4().hex}"

    def cut(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    def matched(rows: DataFrame, against: list[int], name: str) -> DataFrame:
        if not against:
            return rows
        rows = rows.withColumn("mc", clean_account_name(F.coalesce(F.trim("name"), F.trim("kuerzel"))))
        rows = cut(_better(rows, "name", store.name_matches(rows, against), "mc").drop("mc"), f"{name}-names")
        # addresses decide for firms without a name match only
        by_address = match_by_address(rows.where("name_id is null").select(*FIRM_COLUMNS), store._accounts(against))
        best = by_address.select("rec_id", F.col("Id").alias("address_id"), F.col("similarity").alias("address_sim"))
        return _better(rows, "address", best, "rec_id")

    state = matched(cut(new, "new"), versions, "new")
    if known is not None:
        again = [added] if added else []
        todo = known if relink == "best" else known.where("name_id is null and address_id is null")
        rest = None if relink == "best" else known.where("name_id is not null or address_id is not null")
        state = state.unionByName(matched(todo, again, "known"))
        state = state if rest is None else state.unionByName(rest)
    publish(state, f"{store.base}/state")
    return store.crosswalk()
