"""SQL an analyst runs over the loaded listings table."""

from __future__ import annotations

ROLLUP = """
SELECT city, deal_type, count(*) AS n_listings,
       round(avg(price), 4) AS avg_price, min(price) AS min_price, max(price) AS max_price
FROM {table}
GROUP BY city, deal_type
"""

# A top-k report: the limit per city is what is asked for.
DEAREST_PER_CITY = """
WITH ranked AS (
  SELECT city, deal_type, id, price,
         row_number() OVER (PARTITION BY city, deal_type ORDER BY price DESC, id) AS place
  FROM {table}
)
SELECT city, deal_type, place, id, price FROM ranked WHERE place <= 3
"""

CITY_SHARE = """
WITH per_city AS (
  SELECT deal_type, city, count(*) AS n FROM {table} GROUP BY deal_type, city
)
SELECT deal_type, city, n AS n_listings,
       round(n / CAST(sum(n) OVER (PARTITION BY deal_type) AS DOUBLE), 6) AS share
FROM per_city
"""
