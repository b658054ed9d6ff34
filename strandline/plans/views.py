"""Adapter views: reads, depth, genes, exons and intervals made from the driver's tables.

The SQL texts use integer arithmetic that Spark and DuckDB share, so both engines see the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "v_reads": """
SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'S1' ELSE 'S2' END AS sample,
  cast(l_orderkey AS STRING) || '-' || cast(l_linenumber AS STRING) AS qname,
  cast(1 + 2 * (CASE WHEN k % 5 > 0 THEN 1 ELSE 0 END) + 4 * (CASE WHEN k % 17 = 0 THEN 1 ELSE 0 END) + 8 * (CASE WHEN k % 19 = 0 THEN 1 ELSE 0 END)
    + 16 * (k % 2) + 32 * (CASE WHEN k % 3 > 0 THEN 1 ELSE 0 END) + 256 * (CASE WHEN k % 23 = 0 THEN 1 ELSE 0 END)
    + 512 * (CASE WHEN k % 29 = 0 THEN 1 ELSE 0 END) + 1024 * (CASE WHEN k % 13 = 0 THEN 1 ELSE 0 END) + 2048 * (CASE WHEN k % 31 = 0 THEN 1 ELSE 0 END) AS INT) AS flag,
  'chr' || cast(l_partkey % 5 + 1 AS STRING) AS chrom, pos, cast(l_partkey % 61 AS INT) AS mapq,
  CASE k % 4 WHEN 0 THEN '100M' WHEN 1 THEN '60M40S' WHEN 2 THEN '40M5D30M2I10M' ELSE '30S70M' END AS cigar,
  CASE WHEN k % 9 = 0 THEN 'chr9' ELSE '=' END AS rnext, pos + dist AS pnext,
  CASE WHEN k % 2 = 0 THEN dist + 100 ELSE -(dist + 100) END AS tlen,
  CASE WHEN k % 6 = 0 THEN 'chr' || cast((l_partkey + k % 12 / 12) % 5 + 1 AS STRING) || ',' || cast(pos + 90 + l_suppkey % 40 AS STRING) || ',+,50M50S,' || cast(k % 50 AS STRING) || ',1;'
    || (CASE WHEN k % 18 = 0 THEN 'chr2,' || cast(pos + 7 AS STRING) || ',-,70M30S,60,0;bad;' ELSE '' END) END AS sa
FROM (SELECT *, l_orderkey * 8 + l_linenumber AS k, (l_partkey * 37 + l_orderkey * 11) % 20000 + 1 AS pos, 200 + (l_suppkey * 97 + l_orderkey) % 1500 AS dist FROM lineitem) x""",
    "v_depth": """
SELECT 'g' || cast(user_id AS STRING) AS gene, cast(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS pos, cast(floor(value) AS BIGINT) AS depth
FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL""",
    "v_depth_genes": "SELECT gene, cast(1 AS BIGINT) AS start, max(pos) + cast(3 AS BIGINT) AS \"end\" FROM v_depth GROUP BY gene",
    "v_depth_gene_info": """
SELECT gene, start, "end", CASE k % 4 WHEN 0 THEN 'Definitive' WHEN 1 THEN 'Strong' WHEN 2 THEN 'NA' ELSE 'Limited' END AS class, 'NM_' || cast(k AS STRING) || '.1' AS transcript, 'chr' || cast(k % 5 + 1 AS STRING) AS chrom, CASE WHEN k % 2 = 0 THEN '+' ELSE '-' END AS strand, k % 20 + 1 AS exon_count
FROM (SELECT *, cast(substr(gene, 2) AS BIGINT) AS k FROM v_depth_genes) x""",
    "v_genes": """
SELECT 'G' || cast(p_partkey % 97 AS STRING) AS gene, 'NM_' || cast(p_partkey AS STRING) || '.1' AS transcript, 'chr' || cast(p_partkey % 97 % 5 + 1 AS STRING) AS chrom,
  p_partkey % 97 * 211 + p_partkey % 13 * 10 + 1 AS start, p_partkey % 97 * 211 + p_partkey % 13 * 10 + 100 + p_size * 3 AS \"end\", CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM part""",
    "v_core": """
SELECT 'G' || cast(n_nationkey * 5 AS STRING) AS gene, CASE n_regionkey WHEN 0 THEN 'Definitive' WHEN 1 THEN 'Strong' WHEN 2 THEN 'Moderate' WHEN 3 THEN 'Limited' ELSE 'NA' END AS class, cast(n_nationkey AS BIGINT) AS line FROM nation
UNION ALL SELECT 'G' || cast(n_nationkey * 5 AS STRING), 'Strong', cast(n_nationkey + 100 AS BIGINT) FROM nation WHERE n_nationkey % 4 = 0""",
    "v_lengths": "SELECT 'chr' || cast(r_regionkey + 1 AS STRING) AS chrom, cast(20000 + r_regionkey * 100 AS BIGINT) AS length FROM region",
    "v_exons": """
SELECT 'G' || cast(l_partkey % 97 AS STRING) AS gene, 'NM_' || cast(l_partkey % 97 AS STRING) AS transcript, cast(l_orderkey % 40 + 1 AS BIGINT) AS exon, 'chr' || cast(l_partkey % 97 % 5 + 1 AS STRING) AS chrom,
  l_partkey % 97 * 211 + l_orderkey % 40 * 50 + 1 AS start, l_partkey % 97 * 211 + l_orderkey % 40 * 50 + 20 + l_orderkey % 40 % 7 * 6 AS \"end\", CASE l_partkey % 97 % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '?' END AS strand
FROM lineitem GROUP BY 1, 2, 3, 4, 5, 6, 7""",
    "v_split": """
SELECT 'SR' || cast(o_orderkey AS STRING) AS id, CASE WHEN o_custkey % 2 = 0 THEN 'S1' ELSE 'S2' END AS sample, 'chr' || cast(o_orderkey % 5 + 1 AS STRING) AS chrom,
  (o_orderkey * 131 + o_custkey * 17) % 20000 + 1 AS start, (o_orderkey * 131 + o_custkey * 17) % 20000 + 1 + o_custkey * 7 % 400 AS \"end\" FROM orders""",
    "v_depth_iv": """
SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'S1' ELSE 'S2' END AS sample, 'chr' || cast(l_partkey % 5 + 1 AS STRING) AS chrom,
  (l_orderkey * 53 + l_partkey * 29) % 20000 + 1 AS start2, (l_orderkey * 53 + l_partkey * 29) % 20000 + 1 + l_suppkey * 11 % 160 AS end2 FROM lineitem""",
    "v_disc_iv": """
SELECT 'DR' || cast(l_orderkey AS STRING) || '_' || cast(l_linenumber AS STRING) AS did, CASE WHEN l_suppkey % 2 = 0 THEN 'S1' ELSE 'S2' END AS sample, 'chr' || cast(l_partkey % 5 + 1 AS STRING) AS chrom,
  (l_orderkey * 67 + l_partkey * 31) % 20000 + 1 AS start2, (l_orderkey * 67 + l_partkey * 31) % 20000 + 1 + l_suppkey * 13 % 500 AS end2 FROM lineitem""",
    # evidence as callers give it: statuses, reversed intervals, names of chromosomes with and without prefix, and room for all levels of support
    "v_split_raw": """
SELECT 'SR' || cast(o_orderkey AS STRING) AS id, CASE WHEN o_custkey % 2 = 0 THEN 'S1' ELSE 'S2' END AS sample, 'chr' || cast(o_orderkey % 5 + 1 AS STRING) AS chrom, CASE WHEN o_orderkey % 4 = 0 THEN e ELSE s END AS start,
  CASE WHEN o_orderkey % 4 = 0 THEN s ELSE e END AS \"end\", CASE o_orderkey % 7 WHEN 0 THEN 'PASS' WHEN 1 THEN 'NA' WHEN 2 THEN NULL WHEN 3 THEN 'Failed' WHEN 4 THEN 'LowSupport' ELSE 'Pass' END AS status
FROM (SELECT *, (o_orderkey * 131 + o_custkey * 17) % 200000 + 1 AS s, (o_orderkey * 131 + o_custkey * 17) % 200000 + 1 + o_custkey * 7 % 400 AS e FROM orders) x""",
    "v_depth_raw": """
SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'S1' ELSE 'S2' END AS sample, CASE WHEN l_orderkey % 3 = 0 THEN 'chr' ELSE '' END || cast(l_partkey % 5 + 1 AS STRING) AS chrom, CASE WHEN l_linenumber = 3 THEN e ELSE s END AS start2,
  CASE WHEN l_linenumber = 3 THEN s ELSE e END AS end2, CASE l_orderkey % 6 WHEN 0 THEN 'DUP' WHEN 1 THEN NULL WHEN 2 THEN '<DEL>' ELSE 'del' END AS svtype,
  CASE WHEN l_orderkey % 5 = 0 THEN 'NA' ELSE 'DP' || cast(l_orderkey AS STRING) || '_' || cast(l_linenumber AS STRING) END AS depth_id, l_orderkey * 8 + l_linenumber AS line
FROM (SELECT *, (l_orderkey * 53 + l_partkey * 29) % 200000 + 1 AS s, (l_orderkey * 53 + l_partkey * 29) % 200000 + 1 + l_suppkey * 11 % 160 AS e FROM lineitem) x""",
    "v_disc_raw": """
SELECT 'DR' || cast(l_orderkey AS STRING) || '_' || cast(l_linenumber AS STRING) AS did, CASE WHEN l_suppkey % 2 = 0 THEN 'S1' ELSE 'S2' END AS sample, CASE WHEN l_orderkey % 3 = 1 THEN 'chr' ELSE '' END || cast(l_partkey % 5 + 1 AS STRING) AS chrom,
  CASE WHEN l_linenumber = 2 THEN e ELSE s END AS start2, CASE WHEN l_linenumber = 2 THEN s ELSE e END AS end2, CASE l_orderkey % 8 WHEN 0 THEN 'Discarded' WHEN 1 THEN 'LowSupport' WHEN 2 THEN 'failed' WHEN 3 THEN NULL ELSE 'Pass' END AS status,
  CASE l_orderkey % 5 WHEN 0 THEN 'NA' WHEN 1 THEN NULL WHEN 2 THEN 'many' ELSE cast(l_linenumber + 3 AS STRING) END AS discordant_reads, CASE WHEN l_partkey % 4 = 0 THEN 'NA' ELSE cast(l_partkey % 900 + 100 AS STRING) || '.00' END AS median_insert
FROM (SELECT *, (l_orderkey * 67 + l_partkey * 31) % 200000 + 1 AS s, (l_orderkey * 67 + l_partkey * 31) % 200000 + 1 + l_suppkey * 13 % 500 AS e FROM lineitem) x""",
    "v_split_given": """
SELECT *, CASE WHEN k % 3 = 0 THEN 'NA' ELSE 'G' || cast(k % 97 AS STRING) END AS gene, cast(3 + k % 11 AS BIGINT) AS support_reads, cast(3 + k % 11 + k % 4 AS BIGINT) AS support_records
FROM (SELECT *, cast(substr(id, 3) AS BIGINT) AS k FROM v_split_raw) x""",
    "v_files": """
SELECT 'runs/C' || cast(o_custkey AS STRING) || '_' || cast(o_orderkey % 7 AS STRING) || '/' || (CASE o_orderkey % 11 WHEN 0 THEN 'lane' || cast(o_orderkey AS STRING) || '_R1.fastq.gz' WHEN 1 THEN 'lane' || cast(o_orderkey AS STRING) || '.2.fq'
  WHEN 2 THEN cast(o_orderkey AS STRING) || '-1.FASTQ' WHEN 3 THEN 'x' || cast(o_orderkey AS STRING) || '_r2_y.fastq' WHEN 4 THEN 'notes' || cast(o_orderkey AS STRING) || '_1.txt' WHEN 5 THEN 'S1' || cast(o_orderkey AS STRING) || '.fastq'
  WHEN 6 THEN '1_2.' || cast(o_orderkey AS STRING) || '.fq' WHEN 7 THEN 'R2.' || cast(o_orderkey AS STRING) || '.fq.GZ' ELSE 'R1.' || cast(o_orderkey AS STRING) || '.fq' END) AS path FROM orders""",
    "v_mane": "SELECT 'NM_' || cast(CASE WHEN p_partkey % 3 > 0 THEN p_partkey ELSE -p_partkey END AS STRING) AS transcript, 'G' || cast(p_partkey % 97 AS STRING) AS mane_gene FROM part",
    "v_mane_lines": """
SELECT 'NM_' || cast(CASE WHEN p_partkey % 3 > 0 THEN p_partkey ELSE -p_partkey END AS STRING) || '.2' AS transcript, CASE WHEN p_partkey % 97 = 10 THEN 'H' ELSE 'G' END || cast(p_partkey % 97 AS STRING) AS mane_gene, cast(p_partkey AS BIGINT) AS line FROM part""",
    "v_gtf_parts": """
SELECT CASE WHEN l_orderkey % 7 = 0 THEN 'other' ELSE 'G' || cast(l_partkey % 97 AS STRING) END AS gene, 'NM_' || cast(l_partkey AS STRING) AS transcript, 'chr' || cast(l_partkey % 5 + 1 AS STRING) AS chrom, '-' AS strand,
  CASE l_orderkey % 5 WHEN 0 THEN 'transcript' WHEN 1 THEN 'exon' WHEN 2 THEN 'CDS' WHEN 3 THEN '5UTR' ELSE '3UTR' END AS feature, l_orderkey * 7 % 20000 + 1 AS start, l_orderkey * 7 % 20000 + 80 + l_linenumber AS \"end\" FROM lineitem""",
    "v_gtf": """
SELECT 'NM_' || cast(l_partkey AS STRING) AS transcript, CASE l_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'other' ELSE 'G' || cast(l_partkey % 97 AS STRING) END AS gene_name, 'chr' || cast(l_partkey % 5 + 1 AS STRING) AS chrom,
  l_orderkey * 7 % 20000 + 1 AS start, l_orderkey * 7 % 20000 + 80 AS \"end\", '+' AS strand, cast(l_linenumber AS BIGINT) AS exon FROM lineitem""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One adapter view, its tables read where its text names them."""
    text = VIEWS[name].replace('"end"', "`end`").replace("% 12 / 12", "% 12 div 12")
    found = {}
    for table in re.findall(r"(?:FROM|JOIN) (\w+)", text):
        found[table] = view(spark, sf_dir, table) if table in VIEWS else spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spark.sql(re.sub(r"(FROM|JOIN) (\w+)", r"\1 {\2}", text), **found)


def with_views(sql: str) -> str:
    """DuckDB text with the views it uses before it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_\w+", text):
            if name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    heads = ", ".join(f"{n} AS ({VIEWS[n].replace('% 12 / 12', '% 12 // 12').replace(chr(92) + chr(34), chr(34))})" for n in needed)
    body = sql.strip()
    if not needed:
        return body
    if body.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {heads}, {body[15:]}"
    return f"WITH {heads}, {body[5:]}" if body.startswith("WITH ") else f"WITH {heads} {body}"
