"""Oracle SQL for baskets, itemsets (full subset enumeration) and rules."""

from __future__ import annotations

from oracle.catalog import oracle
from oracle.sql import GRADES, band_sql, rnd, token_sql, with_ctes
from quarry import config as C

NB = "CAST((SELECT count(*) FROM bk) AS DOUBLE)"
RULE_CTES = f"""
its AS (
  SELECT array_to_string(sub, '|') AS itemset, len(sub) AS length, count(*) AS freq
  FROM (SELECT list_filter(list_sort(items), lambda x, i: ((m.mask >> (i - 1)) & 1) = 1) AS sub
        FROM bk, range(1, 2048) m(mask) WHERE m.mask < (1 << len(items))) s
  GROUP BY 1, 2
  HAVING CAST(count(*) AS DOUBLE) / {NB} >= CAST({C.MIN_SUPPORT} AS DOUBLE)
), splits AS (
  SELECT i.freq,
    list_filter(string_split(i.itemset, '|'), lambda x, j: ((m.mask >> (j - 1)) & 1) = 1) AS ante,
    list_filter(string_split(i.itemset, '|'), lambda x, j: ((m.mask >> (j - 1)) & 1) = 0) AS cons
  FROM its i, range(1, 2048) m(mask)
  WHERE i.length >= 2 AND m.mask <= (1 << i.length) - 2
), rules AS (
  SELECT s.ante, s.cons,
    s.freq / {NB} AS support,
    (s.freq / {NB}) / (a.freq / {NB}) AS confidence,
    ((s.freq / {NB}) / (a.freq / {NB})) / (c.freq / {NB}) AS lift
  FROM splits s JOIN its a ON array_to_string(s.ante, '|') = a.itemset
                JOIN its c ON array_to_string(s.cons, '|') = c.itemset
), good AS (
  SELECT * FROM rules WHERE confidence >= CAST({C.MIN_CONFIDENCE} AS DOUBLE)
), target AS (
  SELECT *, row_number() OVER (ORDER BY lift DESC, confidence DESC, array_to_string(ante, '|'),
                                        array_to_string(cons, '|')) AS rule_rank
  FROM good WHERE len(list_filter(cons, lambda x: starts_with(x, 'Track_'))) > 0
  ORDER BY rule_rank LIMIT {C.TOP_RULES}
)"""
BASE = with_ctes("bk", RULE_CTES)
TEXT = ("array_to_string(ante, '|') AS antecedents, array_to_string(cons, '|') AS consequents, "
        "round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift")
DISPLAY = (f"{rnd('support * 100.0', 1)} AS support_pct, {rnd('confidence * 100.0', 1)} AS confidence_pct, "
           f"{rnd('lift', 2)} AS lift_2dp")

oracle("basket_long", with_ctes("bk") + "SELECT student_id, unnest(items) AS item FROM bk")
oracle("frequent_itemsets", BASE + f"SELECT itemset, length, CAST(freq AS BIGINT) AS freq, "
       f"round(freq / {NB}, 6) AS support FROM its")
oracle("association_rules", BASE + f"SELECT {TEXT} FROM good")
oracle("rules_with_target", BASE + f"SELECT {TEXT} FROM good "
       "WHERE len(list_filter(cons, lambda x: starts_with(x, 'Track_'))) > 0")
oracle("target_rules", BASE + f"SELECT {TEXT}, rule_rank FROM target")
oracle("top_rules", BASE + f"SELECT {TEXT}, rule_rank FROM (SELECT *, row_number() OVER (ORDER BY lift DESC, "
       "confidence DESC, array_to_string(ante, '|'), array_to_string(cons, '|')) AS rule_rank FROM good) t "
       f"WHERE rule_rank <= {C.TOP_RULES}")
oracle("dashboard_rules", BASE + "SELECT rule_rank, array_to_string(ante, '|') AS antecedents, "
       f"array_to_string(cons, '|') AS consequents, {DISPLAY} FROM target WHERE rule_rank <= {C.DASHBOARD_RULES}")
PROFILE_ITEMS = ("[" + ", ".join(f"{band_sql(g)} || '_{C.ITEM_LABELS[g]}'" for g in GRADES)
                 + f", 'Interest_' || {token_sql('interest')}, CASE WHEN "
                 + " OR ".join(f"{g} < 60" for g in GRADES)
                 + " THEN 'Has_Failed_Course' ELSE 'No_Failed_Courses' END]")
MATCH = (BASE.rstrip() + f""", prof AS (SELECT student_id, {PROFILE_ITEMS} AS items FROM sl),
matched AS (
  SELECT p.student_id, t.*, row_number() OVER (PARTITION BY p.student_id ORDER BY t.rule_rank) AS pos
  FROM prof p, target t
  WHERE len(list_filter(t.ante, lambda x: NOT list_contains(p.items, x))) = 0
)
""")
SEL = (f"SELECT student_id, rule_rank, array_to_string(ante, '|') AS antecedents, "
       f"array_to_string(cons, '|') AS consequents, {DISPLAY} FROM matched")
oracle("match_rules", MATCH + SEL)
oracle("top_rules_per_profile", MATCH + SEL + f" WHERE pos <= {C.RULES_PER_PROFILE}")

BANDS = [f"{b}_{C.ITEM_LABELS[g]}" for g in GRADES for b in ("Excellent", "Good", "Failed", "Weak")]
NAMES = [("Interest_", x) for x in sorted({*C.VALID_INTERESTS, "Undecided"})] + [("Track_", t["track"]) for t in C.TRACKS]
ITEMS = sorted([*BANDS, *(p + "".join(c if c.isalnum() else "_" for c in x) for p, x in NAMES), "Has_Failed_Course", "No_Failed_Courses"])
oracle("basket_matrix", with_ctes("bk") + "SELECT student_id, " + ", ".join(f"list_contains(items, '{v}') AS \"{v}\"" for v in ITEMS) + " FROM bk")
