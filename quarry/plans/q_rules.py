"""Query keys for baskets, frequent itemsets, association rules and matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import config as C
from quarry.functions.bands import basket_items, profile_items
from quarry.operators import rules as R
from quarry.plans.catalog import register
from quarry.plans.derived import bk, materialize, sl
from quarry.session import hand_off


def mined_rules(spark, sf) -> DataFrame:
    """All association rules of the labelled baskets (min support /
    confidence), mined once for all keys that read them."""
    def build():
        baskets = bk(spark, sf)
        its = hand_off(R.frequent_itemsets(baskets, C.MIN_SUPPORT), "itemsets")
        return R.association_rules(its, baskets.select(F.count(F.lit(1))).scalar(), C.MIN_CONFIDENCE)
    return materialize(spark, "rules", sf, build)


def saved_target_rules(spark, sf) -> DataFrame:
    """The top-80 target rules, written once like the original model bundle."""
    return materialize(spark, "target_rules", sf,
                       lambda: R.target_rules(mined_rules(spark, sf), "Track_", C.TOP_RULES))


def _rule_text(df: DataFrame) -> DataFrame:
    return df.select(R.item_key("antecedents").alias("antecedents"),
                     R.item_key("consequents").alias("consequents"),
                     F.round("support", 6).alias("support"), F.round("confidence", 6).alias("confidence"),
                     F.round("lift", 6).alias("lift"),
                     *([F.col("rule_rank")] if "rule_rank" in df.columns else []))


@register("basket_long")
def q_basket_long(spark, sf):
    return R.basket_long(bk(spark, sf))


@register("basket_matrix")
def q_basket_matrix(spark, sf):
    """The boolean basket table over the items that bands, interests and tracks can make."""
    return R.basket_matrix(bk(spark, sf), basket_items())


@register("frequent_itemsets")
def q_frequent_itemsets(spark, sf):
    its = R.frequent_itemsets(bk(spark, sf), C.MIN_SUPPORT)
    return its.select(R.item_key("items").alias("itemset"), "length", "freq",
                      F.round("support", 6).alias("support"))


@register("association_rules")
def q_association_rules(spark, sf):
    return _rule_text(mined_rules(spark, sf))


@register("rules_with_target")
def q_rules_with_target(spark, sf):
    return _rule_text(mined_rules(spark, sf).filter(R.has_prefix("consequents", "Track_")))


@register("target_rules")
def q_target_rules(spark, sf):
    return _rule_text(R.target_rules(mined_rules(spark, sf), "Track_", C.TOP_RULES))


@register("top_rules")
def q_top_rules(spark, sf):
    return _rule_text(R.rank_rules(mined_rules(spark, sf), C.TOP_RULES))


@register("dashboard_rules")
def q_dashboard_rules(spark, sf):
    rules = saved_target_rules(spark, sf).filter(F.col("rule_rank") <= C.DASHBOARD_RULES)
    return rules.select("rule_rank", R.item_key("antecedents").alias("antecedents"),
                        R.item_key("consequents").alias("consequents"), *R.display_rule_columns(rules))


def _profiles_with_items(spark, sf) -> DataFrame:
    return sl(spark, sf).select("student_id", profile_items().alias("items"))


def _matched(spark, sf, per_profile):
    m = R.match_rules(_profiles_with_items(spark, sf), saved_target_rules(spark, sf),
                      per_profile=per_profile)
    return m.select("student_id", "rule_rank", R.item_key("antecedents").alias("antecedents"),
                    R.item_key("consequents").alias("consequents"), *R.display_rule_columns(m))


@register("match_rules")
def q_match_rules(spark, sf):
    return _matched(spark, sf, None)


@register("top_rules_per_profile")
def q_top_rules_per_profile(spark, sf):
    return _matched(spark, sf, C.RULES_PER_PROFILE)
