"""renewlens: Spark-native renewal-feature, scoring and recommendation engine.

Modules:
  params              run parameters and fixed category / search values
  session             local session helper, checkpoint folder
  sources.testdata    the 17 logical source tables derived from the test tables
  sources.store       staging (lineage cut) and dated, rerun-safe sinks
  functions.scalars   column expressions (buckets, keys, dates, ratios)
  operators.joins     range_join, count_upto, or_range_join
  operators.aggs      cond_sums, distinct_count, deterministic_mode
  plans.features      feature builders C1-C12
  plans.scoring       scoring set, linear-logistic and Spark ML scoring
  plans.recommend     counterfactual recommendation search
  plans.monitor       monitoring queries and the daily run
  plans.registry      named queries over the test tables
  oracle_sql          DuckDB SQL used as the correctness oracle
"""
