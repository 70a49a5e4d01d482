"""Queries that read whole tables: every row counts, held against loops over all rows."""

from collections import defaultdict
from itertools import combinations

import duckdb

from contrata.functions import fixed
from contrata.plans import driver, registry

from .conftest import DATA


def test_shared_officers_of_all_orders(spark):
    rows = duckdb.sql(f"select l_suppkey, l_shipdate, o_custkey from '{DATA}/lineitem.parquet' join '{DATA}/orders.parquet' on l_orderkey = o_orderkey").fetchall()
    members, wanted = defaultdict(set), defaultdict(list)
    for supplier, shipped, company in rows:
        members[supplier * 100000 + shipped.year * 12 + shipped.month].add(company)
    few = {p: c for p, c in members.items() if 2 <= len(c) <= 20}
    assert sum(map(len, few.values())) >= 0.98 * sum(map(len, members.values()))
    for person in sorted(few):
        for a, b in combinations(sorted(few[person]), 2):
            wanted[a, b].append(str(person))
    got = registry.queries()["j14_shared_officers"](spark, DATA).collect()
    assert sorted((r.company_a, r.company_b, r.n_shared, r.shared) for r in got) == sorted((a, b, len(p), ",".join(p)) for (a, b), p in wanted.items())


def test_shared_tokens_of_all_parts(spark):
    rows = duckdb.sql(f"select p_partkey, upper(p_name || ' ' || p_type || ' ' || p_brand) from '{DATA}/part.parquet'").fetchall()
    words = {key: {w for w in told.split(" ") if len(w) > 2} for key, told in rows}
    wanted = []
    for a, b in combinations(sorted(words), 2):
        shared = len(words[a] & words[b])
        if shared >= 2 and shared >= 0.6 * min(len(words[a]), len(words[b])):
            wanted.append((a, b, shared))
    got = registry.queries()["j10_shared_tokens"](spark, DATA).collect()
    assert sorted(tuple(r) for r in got) == wanted and {k % 4 for k, _, _ in wanted} == {0, 1, 2, 3}


def test_matching_runs_all_nine_strategies(spark):
    got = driver.q5(spark, DATA).toPandas()
    assert len(fixed.ALIASES) == 16 and got.left_ord.is_unique and "E3b" in set(got.strategy)
