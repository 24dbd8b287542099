"""Matchers and their registry.

A matcher is a function ``(unmatched firms, accounts) -> proposals`` where
proposals are ``(rec_id, Id, ...)`` with at most one row per ``rec_id``. The
waterfall in ``plans.link`` hands each matcher only the firms still unmatched
and fills only NULL links, so an earlier match is never overwritten.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.address import parse_address_line
from ..functions.similarity import jaro_winkler_verify_udf
from ..functions.text import clean_account_name, clean_german_road, split_house_number
from ..operators.fuzzy_join import jaro_winkler_join
from ..operators.topk import best_per_group
from ..session import ensure_checkpoint_dir

MatcherFunc = Callable[[DataFrame, DataFrame], DataFrame]

NAME_THRESHOLD = 0.95      # reference value: similarity must exceed it
ADDRESS_NAME_MIN_SIM = 0.7  # reference value for the name guard after an address join


def match_by_name(firms: DataFrame, accounts: DataFrame,
                  threshold: float = NAME_THRESHOLD,
                  drop_empty_keys: bool = False, materialize: bool = True) -> DataFrame:
    """Name matcher (M1): cleaned ``coalesce(name, kuerzel)`` against cleaned
    ``Account_Name``; equal keys or Jaro-Winkler above ``threshold``; the best
    account per firm by similarity, then smallest ``Id``.

    Returns ``(rec_id, Id, sim, mc, zc)``. Equal empty keys pair with sim 0.0
    as in the reference; ``drop_empty_keys=True`` removes them. With
    ``materialize`` the cleaned inputs are cached while the match runs and the
    proposals (one row per matched firm) are checkpointed, like the reference's
    temporary match table; otherwise a lazy plan is returned.
    """
    m = firms.select("rec_id", clean_account_name(
        F.coalesce(F.trim("name"), F.trim("kuerzel"))).alias("mc"))
    z = accounts.select(F.col("Id").cast("string").alias("Id"),
                        clean_account_name("Account_Name").alias("zc"))
    if drop_empty_keys:
        m, z = m.where(F.col("mc") != ""), z.where(F.col("zc") != "")
    if materialize:
        m, z = m.persist(StorageLevel.MEMORY_AND_DISK), z.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # equal keys score equally, so per key only the smallest Id can win;
        # this aggregate combines map-side even when one key holds many accounts
        best_id = z.where(F.col("zc").isNotNull()).groupBy("zc").agg(F.min("Id").alias("Id"))
        # an equal key cannot be beaten (no other key scores 1, and '' pairs with '' alone),
        # so only firms without one go through the fuzzy join
        names = m.where(F.col("mc").isNotNull()).select("mc").distinct().join(best_id, F.col("mc") == F.col("zc"), "left")
        equal = names.where(F.col("zc").isNotNull()).select(
            "mc", "zc", F.when(F.col("mc") == "", 0.0).otherwise(1.0).alias("sim"), "Id")
        pairs = jaro_winkler_join(names.where(F.col("zc").isNull()).select("mc"), z.select("zc"), threshold,
                                  materialize=materialize)
        scored = pairs.join(best_id, pairs.b == best_id.zc).select(
            F.col("a").alias("mc"), "zc", "sim", "Id")
        best = best_per_group(scored, ["mc"], [("sim", True), ("Id", False)], payload=["zc"])
        best = best.select("mc", "zc", "sim", "Id").unionByName(equal)
        proposals = m.join(best, "mc").select("rec_id", "Id", "sim", "mc", "zc")
        if materialize:
            ensure_checkpoint_dir(proposals.sparkSession)
            proposals = proposals.checkpoint(eager=True)
    finally:
        if materialize:
            m.unpersist()
            z.unpersist()
    return proposals


Parser = Callable[[Column], Column]


def address_features(df: DataFrame, street: str, code: str, parser: Parser = parse_address_line) -> DataFrame:
    """Address line ``street, code, Deutschland`` -> parsed and cleaned parts
    (F12-F16): ``road, house_number, postcode, road_cleaned, house_num_1,
    house_num_2``. ``parser`` gives a struct of the first three from the line: the
    rules, or a trained model's ``parser()``."""
    raw = F.concat(F.col(street), F.lit(", "), F.col(code), F.lit(", Deutschland"))
    parsed = parser(raw)
    hn = split_house_number(parsed["house_number"])
    return df.withColumns({
        "raw_address": raw,
        "road": parsed["road"],
        "house_number": parsed["house_number"],
        "postcode": parsed["postcode"],
    }).withColumns({
        "road_cleaned": clean_german_road("road"),
        "house_num_1": hn["num_1"],
        "house_num_2": hn["num_2"],
    })


def match_by_address(firms: DataFrame, accounts: DataFrame,
                     min_sim: float = ADDRESS_NAME_MIN_SIM, parser: Parser = parse_address_line) -> DataFrame:
    """Address matcher (M2): same cleaned road and the firm's raw ``plz`` equal
    to the account's parsed postcode, plus one house-number form equal; then
    the name guard (similarity > ``min_sim`` or either cleaned name contains
    the other); best account per firm by similarity, then smallest ``Id``.

    ``firms`` should be the unmatched ones. Rows with any NULL among the used
    columns are dropped on both sides, as in the reference. Returns
    ``(rec_id, Id, similarity, name, Account_Name, road_cleaned, plz, house_number)``.
    """
    f = firms.select("rec_id", "name", "plz", "strasse").na.drop("any")
    f = address_features(f, "strasse", "plz", parser)
    a = (accounts.select(F.col("Id").cast("string").alias("Id"), "Account_Name",
                         "Billing_Code", "Billing_Street").na.drop("any"))
    a = address_features(a, "Billing_Street", "Billing_Code", parser)
    fl = f.select("rec_id", "name", "plz", "road_cleaned",
                  F.col("house_number").alias("f_hn"), F.col("house_num_1").alias("f_h1"),
                  F.col("house_num_2").alias("f_h2"),
                  clean_account_name("name").alias("f_clean"))
    ar = a.select("Id", "Account_Name", F.col("road_cleaned").alias("a_road"),
                  "postcode", F.col("house_number").alias("a_hn"),
                  F.col("house_num_1").alias("a_h1"), F.col("house_num_2").alias("a_h2"),
                  clean_account_name("Account_Name").alias("a_clean"))
    # Firms that are copies of one another (same address forms and cleaned
    # name) get the same answer: match each such group once, then join the
    # result back to the firms, so a group holding a third of all rows costs
    # one match, not one per copy.
    gcols = ["road_cleaned", "plz", "f_hn", "f_h1", "f_h2", "f_clean"]
    groups = fl.select(*gcols).distinct()
    # The OR over three house-number forms becomes one equi-join on
    # (road, postcode, form, value): each side has a row per non-NULL form.
    # Accounts at one key with the same cleaned name score the same, so only
    # the smallest Id among them can win: they collapse first (map-side
    # combined), which bounds the pairs at a crowded address by distinct names.
    # A pair matching under several forms appears more than once; the top-1
    # aggregate below absorbs that.
    fk = _house_number_keys(groups, "f")
    ak = (_house_number_keys(ar, "a")
          .groupBy("a_road", "postcode", "_aform", "_aval", "a_clean")
          .agg(F.min(F.struct("Id", "Account_Name")).alias("_acc"))
          .select("a_road", "postcode", "_aform", "_aval", "a_clean",
                  F.col("_acc.Id").alias("Id"), F.col("_acc.Account_Name").alias("Account_Name")))
    joined = fk.join(ak, (fk.road_cleaned == ak.a_road) & (fk.plz == ak.postcode)
                     & (fk._form == ak._aform) & (fk._val == ak._aval))
    # containment is native and cheap; the UDF scores each joined row (a pair
    # matching under several house-number forms is scored once per form)
    scored = joined.withColumn("similarity",
                               jaro_winkler_verify_udf(F.col("f_clean"), F.col("a_clean")))
    kept = scored.where((F.col("similarity") > F.lit(min_sim))
                        | F.col("a_clean").contains(F.col("f_clean"))
                        | F.col("f_clean").contains(F.col("a_clean")))
    best = best_per_group(kept, gcols, [("similarity", True), ("Id", False)],
                          payload=["Account_Name"])
    # back to the firms; house-number forms may be NULL, so compare NULL-safely
    best = best.select(*[F.col(c).alias(f"_g_{c}") for c in gcols],
                       "Id", "similarity", "Account_Name")
    on = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in gcols]
    return fl.join(best, on).select(
        "rec_id", "Id", "similarity", "name", "Account_Name", "road_cleaned", "plz",
        F.col("f_hn").alias("house_number"))


def _house_number_keys(df: DataFrame, side: str) -> DataFrame:
    forms = F.array(*[F.struct(F.lit(i).alias("form"), F.col(f"{side}_{c}").alias("val"))
                      for i, c in enumerate(("hn", "h1", "h2"))])
    p = "" if side == "f" else "a"
    out = df.withColumn("_hk", F.explode(forms)).where(F.col("_hk.val").isNotNull())
    return out.withColumns({f"_{p}form": F.col("_hk.form"), f"_{p}val": F.col("_hk.val")}).drop("_hk")


@dataclass
class Matcher:
    name: str
    func: MatcherFunc
    description: str = ""
    enabled: bool = True


@dataclass
class MatcherRegistry:
    """Ordered matchers (U5). Order is registration order; names are unique."""
    matchers: list[Matcher] = field(default_factory=list)

    def register(self, name: str, func: MatcherFunc, description: str = "",
                 enabled: bool = True) -> Matcher:
        if any(m.name == name for m in self.matchers):
            raise ValueError(f"matcher {name!r} is already registered")
        m = Matcher(name, func, description, enabled)
        self.matchers.append(m)
        return m

    def enable_only(self, names: Iterable[str] | str | None) -> MatcherRegistry:
        """Enable list (M4): a comma list or iterable; when non-empty, a copy of
        the registry in which every other matcher is disabled. A matcher that
        was registered as disabled stays so. Unknown names are ignored."""
        if isinstance(names, str):
            names = [n.strip() for n in names.split(",") if n.strip()]
        names = list(names or [])
        return MatcherRegistry([replace(m, enabled=m.enabled and (not names or m.name in names))
                                for m in self.matchers])

    def enabled(self) -> list[Matcher]:
        return [m for m in self.matchers if m.enabled]


def default_registry() -> MatcherRegistry:
    """The two default matchers in reference order (M5): names, then addresses."""
    reg = MatcherRegistry()
    reg.register("name_match", lambda f, a: match_by_name(f, a),
                 "Cleaned names, equal or very similar")
    reg.register("address_match", lambda f, a: match_by_address(f, a),
                 "Same cleaned road, postcode and a house number in common, names alike")
    return reg
