"""Record matching on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.operators import matching as X
from rowloom.plans.registry import Tables, query


@query("fuzzy_pairs", """
SELECT a.c_name AS left_value, b.s_name AS right_value, CAST(levenshtein(a.c_name, b.s_name) AS INTEGER) AS distance
FROM (SELECT DISTINCT replace(c_name, 'Customer', 'Party') AS c_name FROM customer) a,
     (SELECT DISTINCT replace(s_name, 'Supplier', 'Parts') AS s_name FROM supplier) b
WHERE levenshtein(a.c_name, b.s_name) <= 2
""")
def fuzzy_pairs(t: Tables) -> DataFrame:
    parties = t.customer.select(F.replace("c_name", F.lit("Customer"), F.lit("Party")).alias("c_name"))
    parts = t.supplier.select(F.replace("s_name", F.lit("Supplier"), F.lit("Parts")).alias("s_name"))
    return X.similar_values(parties, parts, "c_name", "s_name", 2)


@query("fuzzy_lookup", """
WITH n AS (SELECT DISTINCT p_name FROM part WHERE p_type = 'PROMO'),
v AS (SELECT DISTINCT p_name FROM part),
best AS (SELECT v.p_name AS value, n.p_name AS match_value, levenshtein(v.p_name, n.p_name) AS d,
    row_number() OVER (PARTITION BY v.p_name ORDER BY levenshtein(v.p_name, n.p_name), n.p_name) AS rn
  FROM v, (SELECT DISTINCT replace(p_name, 'e', '') AS p_name FROM n) n WHERE levenshtein(v.p_name, n.p_name) <= 2)
SELECT p_partkey, p_name, match_value, CAST(d AS INTEGER) AS match_distance FROM part LEFT JOIN best ON value = p_name AND rn = 1
""")
def fuzzy_lookup(t: Tables) -> DataFrame:
    """Part names against the names of promoted parts with a letter left out."""
    promoted = t.part.filter("p_type = 'PROMO'").select(F.replace("p_name", F.lit("e"), F.lit("")).alias("name"))
    return X.fuzzy_lookup(t.part.select("p_partkey", "p_name"), promoted, "p_name", "name", 2)


@query("match_groups", """
WITH RECURSIVE v AS (SELECT DISTINCT p_name AS value FROM part),
edges AS (SELECT a.value AS a, b.value AS b FROM v a, v b WHERE levenshtein(a.value, b.value) <= 2),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT p_partkey, p_name, g AS match_group FROM part JOIN (SELECT a, min(b) AS g FROM reach GROUP BY a) ON a = p_name
""")
def match_groups(t: Tables) -> DataFrame:
    return X.match_groups(t.part.select("p_partkey", "p_name"), "p_name", 2)


@query("survivors", """
SELECT c_nationkey, arg_max(c_name, (c_acctbal, c_name)) AS c_name, max(c_acctbal) AS c_acctbal,
  (SELECT seg FROM (SELECT c_mktsegment AS seg, count(*) AS n FROM customer i WHERE i.c_nationkey = o.c_nationkey GROUP BY 1
                    ORDER BY n DESC, seg LIMIT 1)) AS c_mktsegment
FROM customer o GROUP BY c_nationkey
""")
def survivors(t: Tables) -> DataFrame:
    rules = {"c_name": ("latest", "c_acctbal"), "c_acctbal": ("highest", None), "c_mktsegment": ("most_common", None)}
    return X.survivors(t.customer, ["c_nationkey"], rules)
