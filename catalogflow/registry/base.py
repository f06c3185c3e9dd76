"""Shared inputs of the registered queries.

The listing expressions below are plain SQL that Spark and DuckDB read alike, so a query and
its check SQL start from the same rows of the given tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.captures import read_pages

Query = Callable[[SparkSession, str], DataFrame]


def given_pages(s: SparkSession, d: str) -> DataFrame:
    """The given pages, which lie in one split, dealt out."""
    return read_pages(s, f"{d}/pages.parquet", int(s.conf.get("spark.sql.shuffle.partitions")))


RUN_AT = "2024-07-05 01:02:03"

# Listing fields derived from ``part``; k is the part key.
K = "p_partkey"
LISTING: dict[str, str] = {
    "k": K,
    "source_pos": f"cast({K} % 3 AS int)",
    "url": f"'https://shop.example.com/i/' || lpad(cast({K} AS string), 6, '0')",
    "maker_text": "p_brand",
    "product_name_text": "p_name || '　メモリ  ' || p_type",
    "product_number_text": f"""CASE {K} % 6 WHEN 0 THEN '型番：PN-' || cast({K} AS string)
        WHEN 1 THEN '商品番号: A' || cast({K} AS string) || ' x' WHEN 2 THEN 'sku : t' || cast({K} AS string)
        WHEN 3 THEN '品番　:　H' || cast({K} AS string) WHEN 4 THEN '' ELSE 'no label' END""",
    "original_price_text": f"""CASE WHEN {K} % 3 = 0 THEN '通常 ¥' || cast(20 + {K} % 50 AS string) || ',' ||
        lpad(cast({K} % 1000 AS string), 3, '0') ELSE '' END""",
    "final_price_text": f"""CASE {K} % 5 WHEN 0 THEN '¥' || cast(1 + {K} % 50 AS string) || ',' ||
        lpad(cast({K} % 1000 AS string), 3, '0') WHEN 1 THEN cast(1000 + {K} AS string) || '円'
        WHEN 2 THEN '￥ ' || cast(9000 + {K} AS string) || ' 税込' WHEN 3 THEN '価格未定' ELSE '' END""",
    "coupon_text": f"""CASE {K} % 4 WHEN 0 THEN '500円OFF' WHEN 1 THEN '￥1,200 オフ' WHEN 2 THEN '99,999 円　引き'
        ELSE '' END""",
    "sale_text": f"""CASE {K} % 6 WHEN 0 THEN '7/1 10:00 ~ 7/10 9:59' WHEN 3 THEN '8/5 23:59まで'
        WHEN 4 THEN '12/28 0:00から1/4 23:59' WHEN 5 THEN 'セール中' ELSE '' END""",
    "stock_text": f"""CASE {K} % 5 WHEN 0 THEN ' 在庫あり ' WHEN 1 THEN 'お取り寄せ' WHEN 2 THEN '' WHEN 3 THEN '確認中'
        ELSE '予約 即納' END""",
    "spec_text": f"""CASE {K} % 8 WHEN 0 THEN 'DDR5-' || cast(4000 + 400 * ({K} % 7) AS string) || ' 32GB(16GB×2)'
        WHEN 1 THEN 'LPDDR 5 16GB x ' || cast(1 + {K} % 4 AS string) WHEN 2 THEN '8GBモジュール 2枚組 3200MHz'
        WHEN 3 THEN '32GBのメモリ DDR5メモリ' WHEN 4 THEN 'DDR 5 64gb' WHEN 5 THEN '4kit 0.5GB x 2'
        WHEN 6 THEN 'ddr4 2666 M.2 NVMe 1.5TB' ELSE '' END""",
    "tags_text": f"""CASE {K} % 7 WHEN 0 THEN 'DDR 5|32GB|4800MHz' WHEN 1 THEN '8GB|16GB(8GB×2)|64GB( 16GB x 4 )'
        WHEN 2 THEN '新品||2枚組' WHEN 3 THEN '1TB以上〜2TB|NVMe SSD|M.2 2280' WHEN 4 THEN '〜960GB|SATA|2.5インチ'
        WHEN 5 THEN '500GB|PCIe 4.0|500GB以上' ELSE '' END""",
}
LISTING_SQL = "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in LISTING.items()) + " FROM part"
# One long text per part: head, capacity, price, stock, sale.
LISTING_TEXT = f"""p_brand || ' ' || p_name || ' メモリ DDR' || cast(4 + {K} % 2 AS string) || '-' ||
    cast(2400 + 400 * ({K} % 8) AS string) || ' ' || cast(8 * (1 + {K} % 4) * (1 + {K} % 2) AS string) || 'GB(' ||
    cast(8 * (1 + {K} % 4) AS string) || 'GB x ' || cast(1 + {K} % 2 AS string) || ')' ||
    CASE {K} % 4 WHEN 0 THEN ' ¥' || cast(1 + {K} % 50 AS string) || ',' || lpad(cast({K} % 1000 AS string), 3, '0')
        WHEN 1 THEN ' ' || cast(1000 + {K} AS string) || '円' WHEN 2 THEN ' ￥' || cast(9000 + {K} AS string) || ' 500円OFF'
        ELSE ' 価格未定' END ||
    CASE {K} % 3 WHEN 0 THEN ' 在庫あり' WHEN 1 THEN ' お取り寄せ' ELSE '' END ||
    CASE {K} % 6 WHEN 0 THEN ' 7/1 10:00 ~ 7/10 9:59' WHEN 3 THEN ' 8/5 23:59まで' ELSE '' END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows from ``part``; ``tags`` is the split tag text."""
    rows = table(spark, sf_dir, "part").select(*[F.expr(sql).alias(name) for name, sql in LISTING.items()])
    return rows.withColumn("tags", F.split("tags_text", r"\|"))


def with_listing(body: str) -> str:
    return f"WITH listing AS ({LISTING_SQL}) {body}"


# --- DuckDB text helpers for the check SQL ----------------------------------------------
WS = r"[\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
NWS = r"[^\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def d_trim(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def d_compact(c: str) -> str:
    step = f"regexp_replace(replace(coalesce({c}, ''), chr(160), ' '), '[\\t\\r\\n]+', ' ', 'g')"
    return d_trim(f"regexp_replace({step}, '{WS}{{2,}}', ' ', 'g')")


def d_norm(c: str) -> str:
    return d_trim(f"regexp_replace({c}, '{WS}+', ' ', 'g')")


def d_get(c: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({c}, '{pattern}', {group}), '')"


def d_num(c: str) -> str:
    return f"try_cast(replace({c}, ',', '') AS BIGINT)"


def d_any(c: str, words: tuple[str, ...] | list[str]) -> str:
    return "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"
