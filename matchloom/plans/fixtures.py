"""Record-like views over the driver's tables, in SQL that Spark and DuckDB both read. {name} stands for a table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "biz": """
        SELECT p_partkey AS n, concat('S', cast(p_partkey % 3 + 1 AS string), '-', cast(p_partkey AS string)) AS entity_id,
          concat(p_name, CASE p_partkey % 4 WHEN 0 THEN ' llc' WHEN 1 THEN ' pvt ltd' WHEN 2 THEN '' ELSE ' inc' END) AS business_name,
          concat(cast(p_size AS string), ' ', lower(p_type), ' street ', replace(lower(p_brand), '#', ' ')) AS business_address,
          CASE WHEN length(p_brand) = 7 AND p_partkey % 2 = 0 THEN 'US' ELSE 'India' END AS country, lower(p_name) AS name_core,
          concat(cast(p_size AS string), ' ', lower(p_type), ' street ', replace(lower(p_brand), '#', ' ')) AS addr_norm,
          lower(concat(p_name, CASE p_partkey % 4 WHEN 0 THEN ' llc' WHEN 1 THEN ' pvt ltd' WHEN 2 THEN '' ELSE ' inc' END)) AS name_norm,
          CASE p_partkey % 4 WHEN 0 THEN 'llc' WHEN 1 THEN 'ltd pvt' WHEN 2 THEN '' ELSE 'inc' END AS name_suffix,
          CASE WHEN p_partkey % 9 = 0 THEN 'alias' ELSE '' END AS name_alias, replace(lower(p_name), ' ', '') AS name_compact, p_partkey % 10 = 0 AS is_website,
          CASE WHEN p_partkey % 7 = 0 THEN split_part(lower(p_name), ' ', 1) ELSE '' END AS acronym, split_part(lower(p_name), ' ', 1) AS first_token,
          CASE WHEN p_partkey % 5 = 0 THEN lower(p_type) ELSE '' END AS landmark, CASE p_partkey % 4 WHEN 0 THEN 'up' WHEN 1 THEN 'tn' WHEN 2 THEN 'up tn' ELSE '' END AS region,
          concat(cast(p_size AS string), ' ', replace(lower(p_brand), 'brand#', '')) AS digits, cast(p_size AS string) AS house_no,
          CASE WHEN p_partkey % 3 = 0 THEN cast(10000 + p_size AS string) ELSE '' END AS long_nums, p_partkey % 11 = 0 AS addr_empty
        FROM {part}""",
    "s1": "SELECT * FROM {biz} WHERE entity_id LIKE 'S1-%'",
    "oth": "SELECT * FROM {biz} WHERE entity_id NOT LIKE 'S1-%'",
    "truth_biz": """
        SELECT concat('S1-', cast(a.k AS string)) AS s1_id, b.entity_id AS cand_id
        FROM (SELECT name_core, addr_norm, min(n) AS k FROM {s1} GROUP BY name_core, addr_norm) a JOIN {oth} b ON a.name_core = b.name_core AND a.addr_norm = b.addr_norm""",
    "scored": """
        SELECT concat('S1-', cast(o_custkey AS string)) AS s1_id, concat('S', cast(o_orderkey % 2 + 2 AS string), '-', cast(o_orderkey % 997 AS string)) AS cand_id,
          max(cast((o_orderkey * 7919) % 1000 AS double) / 1000) AS prob FROM {orders} GROUP BY 1, 2""",
    "truth": """
        SELECT DISTINCT concat('S1-', cast(o_custkey AS string)) AS s1_id, concat('S', cast(o_orderkey % 2 + 2 AS string), '-', cast(o_orderkey % 997 AS string)) AS cand_id
        FROM {orders} WHERE (o_orderkey * 31) % 10 < 3""",
    "universe": "SELECT concat('S1-', cast(c_custkey AS string)) AS s1_id, CASE WHEN c_nationkey < 10 THEN 'US' ELSE 'India' END AS country FROM {customer}",
    "cov": "SELECT CASE WHEN event_id % 2 = 0 THEN 'train' ELSE 'test' END AS split, event_type AS country, value, cast(length(props) AS double) AS props_len FROM {events}",
    "idtext": """
        SELECT o_orderkey AS n, concat('S1-', cast(o_custkey AS string)) AS s1_id,
          concat(' S2-', cast(o_orderkey % 50 AS string), ',', CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'S3-7' ELSE concat('S2-', cast(o_orderkey % 50 AS string)) END, ', ', CASE o_orderkey % 9 WHEN 0 THEN 'X-1' WHEN 1 THEN 'S1-3' ELSE 'S3-9' END) AS ids
        FROM {orders}""",
    "doc": "SELECT doc_id, lower(coalesce(text, '')) AS line, text, lang FROM {documents}",
    "emb": "SELECT vec_id, label, embedding, CASE WHEN vec_id % 4 = 0 THEN 'q' ELSE 'x' END AS side FROM {embeddings}",
}


def names_in(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{([a-z]\w*)\}", sql)))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a table of the driver."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(VIEWS[name], **{n: view(spark, sf_dir, n) for n in names_in(VIEWS[name])})


def with_views(sql: str) -> str:
    """A query with the views that it names as common tables, for DuckDB."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in VIEWS and name not in order:
            for n in names_in(VIEWS[name]):
                need(n)
            order.append(name)

    for n in names_in(sql):
        need(n)
    plain = lambda text: re.sub(r"\{([a-z]\w*)\}", r"\1", text)
    head = ", ".join(f"{n} AS ({plain(VIEWS[n])})" for n in order)
    body = plain(sql).strip()
    if not head:
        return body
    return f"WITH {head}, {body[5:]}" if body.startswith("WITH ") else f"WITH {head} {body}"
