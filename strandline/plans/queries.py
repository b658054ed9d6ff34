"""Registered queries of the deletion-evidence operators, each with DuckDB SQL where SQL expresses it simply."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from strandline.operators import depth as D
from strandline.operators import evidence as E
from strandline.operators import candidates, depth_tables, folds, intervals, regions, reports, simulate
from strandline.operators import reads as R
from strandline.operators.quantiles import exact_quantiles
from strandline.functions import genome as G
from strandline.plans.views import view, with_views
from strandline.sources import bam, listing, tee
from strandline.sources.written import shared_folder

QUERIES, SQL = {}, {}
WINDOW, STEP, LEAST = 20, 8, 8


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql if re.match(r"\s*WITH (RECURSIVE )?v_", sql) else with_views(sql)  # as it is, if the views are there
        return f

    return add


@query("""WITH b AS (SELECT gene, arg_min(class, (CASE class WHEN 'Definitive' THEN -5 WHEN 'Strong' THEN -4 WHEN 'Moderate' THEN -3 WHEN 'Limited' THEN -2 WHEN 'Disputed' THEN -1 ELSE 0 END) * 1000000 + line) AS class FROM v_core GROUP BY 1)
SELECT gene, class, string_agg(DISTINCT transcript, ',' ORDER BY transcript) AS transcripts, min(chrom) AS chrom, min(start) AS start, max("end") AS "end" FROM v_genes JOIN b USING (gene) GROUP BY 1, 2""")
def core_gene_regions(s, d):
    return regions.core_gene_regions(view(s, d, "v_genes"), view(s, d, "v_core"))


@query("SELECT DISTINCT gene FROM v_core WHERE gene NOT IN (SELECT gene FROM v_genes)")
def missing_core_genes(s, d):
    return regions.missing_genes(view(s, d, "v_core"), view(s, d, "v_genes"))


TARGETS = """g AS (SELECT gene, min(chrom) AS chrom, min(start) AS start, max("end") AS "end" FROM v_genes WHERE gene IN (SELECT gene FROM v_core) GROUP BY 1),
t AS (SELECT g.*, greatest(1, start - 500) AS target_start, least(length, "end" + 500) AS target_end FROM g JOIN v_lengths USING (chrom))"""


def _targets(s, d):
    return regions.target_regions(core_gene_regions(s, d).select("gene", "chrom", "start", "end"), view(s, d, "v_lengths"), 500)


@query(f"WITH {TARGETS} SELECT * FROM t")
def target_regions(s, d):
    return _targets(s, d)


MERGED = f"""{TARGETS}, o AS (SELECT *, max(target_end) OVER (PARTITION BY chrom ORDER BY target_start, target_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM t),
i AS (SELECT *, sum(CASE WHEN top IS NULL OR target_start > top + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY target_start, target_end ROWS UNBOUNDED PRECEDING) AS island FROM o),
m AS (SELECT chrom, min(target_start) AS start, max(target_end) AS "end", string_agg(DISTINCT gene, ',' ORDER BY gene) AS gene FROM i GROUP BY chrom, island)"""


@query(f"WITH {MERGED} SELECT * FROM m")
def merged_regions(s, d):
    return regions.merged_targets(_targets(s, d))


@query(f"WITH {MERGED.replace('500', '340')} SELECT * FROM m")
def regions_apart(s, d):
    """With flanks at which some neighbours merge and some do not."""
    genes = core_gene_regions(s, d).select("gene", "chrom", "start", "end")
    return regions.merged_targets(regions.target_regions(genes, view(s, d, "v_lengths"), 340))


@query(f'WITH {MERGED} SELECT chrom, start - 1 AS start, "end", gene AS genes FROM m')
def bed(s, d):
    return regions.to_bed(regions.merged_targets(_targets(s, d)))


@query("""SELECT coalesce(CASE WHEN pos < 1 THEN 'invalid' WHEN flag & 1 <> 1 THEN 'flag_required' WHEN flag & 3844 <> 0 THEN 'flag_excluded' WHEN mapq < 20 THEN 'low_mapq' END, 'used') AS reason, count(*) AS n FROM v_reads GROUP BY 1""")
def read_filter_reasons(s, d):
    return R.with_reason(view(s, d, "v_reads"), *R.SPLIT, 20).groupBy(F.coalesce("reason", F.lit("used")).alias("reason")).agg(F.count("*").alias("n"))


LENGTH = "list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MDN=X]', 1), lambda x: x::BIGINT))::BIGINT"


@query(f"""WITH r AS (SELECT sample, qname, chrom, pos, pos + {LENGTH} - 1 AS "end" FROM v_reads), {MERGED}
SELECT sample, qname, chrom, pos AS start, "end" FROM r WHERE EXISTS (SELECT 1 FROM m WHERE m.chrom = r.chrom AND r.pos <= m."end" AND r."end" >= m.start)""")
def region_semi_join(s, d):
    r = view(s, d, "v_reads").select("sample", "qname", "chrom", F.col("pos").alias("start"), (F.col("pos") + G.cigar_ref_length(F.col("cigar")) - 1).alias("end"))
    return intervals.interval_join(r, regions.merged_targets(_targets(s, d)).select("chrom", F.col("start").alias("start2"), F.col("end").alias("end2")), "left_semi")


def _as_bam(s, d) -> str:
    """The reads as sorted, indexed BAM parts; chr9 holds mates only."""
    path = f"{shared_folder(s)}/reads-{uuid.uuid4().hex}.bam"
    bam.write_bam(view(s, d, "v_reads"), path, [(r["chrom"], r["length"]) for r in view(s, d, "v_lengths").orderBy("chrom").collect()] + [("chr9", 20000)])
    return path


@query(SQL["region_semi_join"])
def bam_region_scan(s, d):
    spans = [(r["chrom"], r["start"], r["end"]) for r in regions.merged_targets(_targets(s, d)).select("chrom", "start", "end").collect()]  # as many as there are core genes, at most
    r = bam.read_bam(s, _as_bam(s, d), spans)
    return r.select("sample", "qname", "chrom", F.col("pos").alias("start"), (F.col("pos") + G.cigar_ref_length(F.col("cigar")) - 1).alias("end"))


@query("SELECT sample, qname, flag, chrom, pos, mapq, cigar, rnext, pnext, tlen, sa FROM v_reads")
def bam_round_trip(s, d):
    return bam.read_bam(s, _as_bam(s, d), split_bytes=1 << 20)


@query(f"""WITH {TARGETS},
u AS (SELECT * FROM v_reads WHERE flag & 3844 = 0 AND mapq >= 20),
b AS (SELECT sample, chrom, pos AS s, pos + CASE cigar WHEN '100M' THEN 99 WHEN '60M40S' THEN 59 WHEN '30S70M' THEN 69 ELSE 39 END AS e FROM u
      UNION ALL SELECT sample, chrom, pos + 45, pos + 84 FROM u WHERE cigar = '40M5D30M2I10M'),
p AS (SELECT sample, gene, t.chrom, unnest(generate_series(t.start, t."end")) AS pos FROM t, (SELECT DISTINCT sample FROM v_reads)),
x AS (SELECT b.sample, t.gene, unnest(generate_series(greatest(b.s, t.start), least(b.e, t."end"))) AS pos FROM b JOIN t ON b.chrom = t.chrom AND b.s <= t."end" AND b.e >= t.start),
c AS (SELECT sample, gene, pos, count(*) AS n FROM x GROUP BY ALL)
SELECT p.sample, p.gene, p.chrom, p.pos, coalesce(c.n, 0)::BIGINT AS depth FROM p LEFT JOIN c USING (sample, gene, pos)""")
def pileup_depth(s, d):
    return D.pileup(view(s, d, "v_reads"), _targets(s, d).select("gene", "chrom", "start", "end"))


@query(SQL["pileup_depth"].rsplit("SELECT p.sample", 1)[0] + """, q AS (SELECT p.sample, p.gene, p.chrom, p.pos, coalesce(c.n, 0)::BIGINT AS depth FROM p LEFT JOIN c USING (sample, gene, pos)),
st AS (SELECT *, CASE WHEN depth = lag(depth) OVER (PARTITION BY sample, gene ORDER BY pos) THEN 0 ELSE 1 END AS fresh FROM q),
rn AS (SELECT *, sum(fresh) OVER (PARTITION BY sample, gene ORDER BY pos) AS run FROM st)
SELECT sample, gene, chrom, min(pos) AS start, max(pos) AS "end", any_value(depth) AS depth FROM rn GROUP BY sample, gene, chrom, run""")
def depth_run_lengths(s, d):
    return D.joined_runs(D.depth_runs(view(s, d, "v_reads"), _targets(s, d).select("gene", "chrom", "start", "end")))


MEAN = 'gm AS (SELECT g.gene, g.start, g."end", coalesce(sum(depth), 0)::DOUBLE / (g."end" - g.start + 1) AS gene_mean FROM v_depth_genes g LEFT JOIN v_depth d ON d.gene = g.gene AND d.pos BETWEEN g.start AND g."end" GROUP BY g.gene, g.start, g."end")'


@query(f"WITH {MEAN} SELECT * FROM gm")
def gene_mean_depth(s, d):
    return D.gene_mean_depth(view(s, d, "v_depth"), view(s, d, "v_depth_genes"))


RATIO = f"""{MEAN}, w0 AS (SELECT gene, "end", unnest(generate_series(start, "end", {STEP})) AS w_start, gene_mean FROM gm),
w AS (SELECT gene, ((w_start - 1) // {STEP} + 1)::BIGINT AS number, w_start, least(w_start + {WINDOW - 1}, "end") AS w_end, gene_mean FROM w0 WHERE least(w_start + {WINDOW - 1}, "end") - w_start + 1 >= {LEAST}),
wm AS (SELECT w.gene, number, w_start, w_end, gene_mean, coalesce(sum(depth), 0)::DOUBLE / (w_end - w_start + 1) AS window_mean FROM w LEFT JOIN v_depth d ON d.gene = w.gene AND d.pos BETWEEN w_start AND w_end GROUP BY w.gene, number, w_start, w_end, gene_mean),
r AS (SELECT *, CASE WHEN gene_mean > 0 THEN window_mean / gene_mean END AS ratio FROM wm),
st AS (SELECT *, CASE WHEN gene_mean < 20 THEN 'Low_gene_depth' WHEN ratio IS NULL THEN 'NA' WHEN ratio <= 0.9 THEN 'Del_window' ELSE 'Normal_window' END AS status FROM r)"""


@query(f"WITH {RATIO} SELECT * FROM st")
def window_ratio(s, d):
    return D.window_ratios(view(s, d, "v_depth"), view(s, d, "v_depth_genes"), WINDOW, STEP, LEAST, 20.0, 0.9)


@query(f"WITH {RATIO} SELECT * FROM st WHERE status = 'Del_window'")
def del_windows(s, d):
    return window_ratio(s, d).filter("status = 'Del_window'")


@query(f"""WITH {RATIO}, n AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY w_start) AS place FROM st),
q AS (SELECT *, place - row_number() OVER (PARTITION BY gene ORDER BY w_start) AS run FROM n WHERE status = 'Del_window')
SELECT gene, min(w_start) AS start, max(w_end) AS "end", count(*) AS n_windows, sum(window_mean * (w_end - w_start + 1)) / sum(w_end - w_start + 1) AS mean_depth, avg(ratio) AS mean_ratio, min(ratio) AS min_ratio, max(ratio) AS max_ratio,
  string_agg('W' || number, ',' ORDER BY number) AS window_ids FROM q GROUP BY gene, run HAVING count(*) >= 2""")
def window_candidates(s, d):
    return D.window_candidates(window_ratio(s, d), 2)


NAMED = """'S1' AS "SampleID", gene AS "Gene", class AS "Classification", transcript AS "Transcript\""""
WINDOWED = f"""{RATIO}, gi AS (SELECT * FROM v_depth_gene_info),
rt AS (SELECT {NAMED}, gene || '_W' || number AS "Window_ID", chrom AS "Chrom", w_start AS "Start", w_end AS "End", w_end - w_start + 1 AS "Length", gi.start AS "Gene_Start", gi."end" AS "Gene_End", printf('%.4f', gene_mean) AS "Gene_Mean_Depth",
  printf('%.4f', window_mean) AS "Window_Mean_Depth", CASE WHEN ratio IS NOT NULL THEN printf('%.4f', ratio) END AS "Depth_Ratio", CASE WHEN status = 'Del_window' THEN 'Yes' ELSE 'No' END AS "Is_Del_Window", status AS "Window_Status",
  CASE status WHEN 'Low_gene_depth' THEN 'Gene mean depth is lower than MIN_GENE_MEAN_DEPTH; window is not evaluated as deletion' WHEN 'NA' THEN 'Depth ratio cannot be calculated' WHEN 'Del_window' THEN 'Depth ratio <= DEL_DEPTH_RATIO_CUTOFF' ELSE 'Depth ratio > DEL_DEPTH_RATIO_CUTOFF' END AS "Comment"
  FROM st JOIN gi USING (gene))"""


@query(f"""WITH {WINDOWED}, gq AS (SELECT g.gene, coalesce(sum(depth), 0)::DOUBLE / (g."end" - g.start + 1) AS gene_mean FROM v_depth_genes g LEFT JOIN v_depth d ON d.gene = g.gene AND d.pos BETWEEN g.start AND g."end" GROUP BY g.gene, g.start, g."end")
SELECT {NAMED}, chrom AS "Chrom", start AS "Start", "end" AS "End", strand AS "Strand", exon_count AS "ExonCount", concat_ws('|', gene, transcript, chrom, start, "end") AS "Gene_Key", "end" - start + 1 AS "Gene_Length", printf('%.4f', gq.gene_mean) AS "Gene_Mean_Depth",
  (SELECT count(*) FROM st WHERE st.gene = gi.gene) AS "Window_Count" FROM gi JOIN gq USING (gene)""")
def gene_depth_table(s, d):
    means = D.gene_mean_depth(view(s, d, "v_depth"), view(s, d, "v_depth_genes"))
    windows = D.sliding_windows(view(s, d, "v_depth_genes"), WINDOW, STEP, LEAST)
    return depth_tables.gene_table(means, windows, view(s, d, "v_depth_gene_info"), "S1")


@query(f"WITH {WINDOWED} SELECT * FROM rt")
def window_ratio_table(s, d):
    return depth_tables.ratio_table(window_ratio(s, d), view(s, d, "v_depth_gene_info"), "S1")


@query(f"""WITH {WINDOWED} SELECT * EXCLUDE ("Gene_Mean_Depth", "Depth_Ratio", "Is_Del_Window", "Window_Status", "Comment") FROM rt""")
def window_depth_table(s, d):
    return depth_tables.window_table(window_ratio(s, d), view(s, d, "v_depth_gene_info"), "S1")


@query(f"""WITH {WINDOWED}, n AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY w_start) AS place FROM st),
q AS (SELECT *, place - row_number() OVER (PARTITION BY gene ORDER BY w_start) AS run FROM n WHERE status = 'Del_window'),
c AS (SELECT gene, min(w_start) AS s1, max(w_end) AS e1, count(*) AS n_windows, any_value(gene_mean) AS gene_mean, sum(window_mean * (w_end - w_start + 1)) / sum(w_end - w_start + 1) AS mean_depth, avg(ratio) AS mean_ratio, min(ratio) AS lo, max(ratio) AS hi,
  string_agg(gene || '_W' || number, ',' ORDER BY number) AS ids FROM q GROUP BY gene, run HAVING count(*) >= 2)
SELECT {NAMED}, chrom AS "Chrom", s1 AS "Start", e1 AS "End", e1 - s1 + 1 AS "Candidate_Length", n_windows AS "Window_Count", printf('%.4f', gene_mean) AS "Gene_Mean_Depth", printf('%.4f', mean_depth) AS "Candidate_Mean_Depth", printf('%.4f', mean_ratio) AS "Mean_Depth_Ratio",
  printf('%.4f', lo) AS "Min_Depth_Ratio", printf('%.4f', hi) AS "Max_Depth_Ratio", 'Depth_candidate' AS "Candidate_Status", ids AS "Del_Window_IDs", 'Merged consecutive deletion-supporting windows' AS "Comment" FROM c JOIN gi USING (gene)""")
def depth_candidate_table(s, d):
    return depth_tables.candidate_table(window_ratio(s, d), view(s, d, "v_depth_gene_info"), "S1", 2)


BINS = "bins AS (SELECT gene, ((pos - 1) // 2) * 2 + 1 AS start, max(pos) AS \"end\", avg(depth) AS depth, count(*) AS n_pos FROM v_depth GROUP BY 1, 2)"


@query(f"WITH {BINS} SELECT * FROM bins")
def cusum_bins(s, d):
    return D.depth_bins(view(s, d, "v_depth"), 2)


@query(f"WITH {BINS} SELECT gene, median(depth) AS baseline FROM bins WHERE depth > 0 GROUP BY 1")
def cusum_baseline(s, d):
    return D.with_baseline(cusum_bins(s, d)).select("gene", "baseline").distinct()


# The state after each bin, one bin a step; an event is there in the bin that closes it.
CUSUM = f"""{BINS}, bl AS (SELECT gene, median(depth) AS baseline FROM bins WHERE depth > 0 GROUP BY 1),
cb AS (SELECT gene, start, "end", depth, baseline, (depth + 0.1) / (baseline + 0.1) AS r, row_number() OVER (PARTITION BY gene ORDER BY start) AS i FROM bins JOIN bl USING (gene)),
cl AS (SELECT gene, list(r ORDER BY i) AS rs, count(*) AS n FROM cb GROUP BY 1),
cs AS (SELECT gene, 0::BIGINT AS i, 0::DOUBLE AS s, NULL::BIGINT AS cand, false AS ins, 0::BIGINT AS quiet, 0::BIGINT AS beg, 0::DOUBLE AS top, NULL::BIGINT AS stop, n FROM cl
  UNION ALL SELECT gene, i, CASE WHEN closed THEN 0 ELSE s END, CASE WHEN closed OR (NOT ins AND s = 0) THEN NULL ELSE cand END, ins AND NOT closed, CASE WHEN closed THEN 0 ELSE quiet END, beg, top, CASE WHEN closed THEN i - quiet END, n
  FROM (SELECT *, ins AND quiet >= 3 AS closed FROM (SELECT gene, i, s, cand, ins OR alarm AS ins, n,
      CASE WHEN (ins OR alarm) AND r >= 0.8 THEN CASE WHEN alarm THEN 0 ELSE quiet END + 1 ELSE 0 END AS quiet,
      CASE WHEN alarm THEN coalesce(list_min(list_filter(range(coalesce(cand, i), i + 1), lambda j: rs[j] <= 0.8)), cand, i) ELSE beg END AS beg, CASE WHEN alarm THEN s WHEN ins THEN greatest(top, s) ELSE top END AS top
    FROM (SELECT *, NOT ins AND s >= 1.0 AS alarm FROM (SELECT cs.gene, cb.i, greatest(0, cs.s + (1 - cb.r - 0.1)) AS s, CASE WHEN NOT cs.ins AND cs.s = 0 AND 1 - cb.r - 0.1 > 0 THEN cb.i ELSE cs.cand END AS cand, cs.ins, cs.quiet, cs.beg, cs.top, cs.n, cb.r, cl.rs
      FROM cs JOIN cb ON cb.gene = cs.gene AND cb.i = cs.i + 1 JOIN cl ON cl.gene = cs.gene))))),
ce AS (SELECT gene, beg, coalesce(stop, n) AS stop, top FROM cs WHERE stop IS NOT NULL OR (ins AND i = n))"""


@query(f"""WITH RECURSIVE {CUSUM} SELECT gene, min(start) AS start, max("end") AS "end", max("end") - min(start) + 1 AS length, count(*) AS n_bins, any_value(baseline) AS baseline, avg(depth) AS mean_depth, avg(r) AS mean_ratio, min(r) AS min_ratio, any_value(top) AS max_cusum
FROM ce JOIN cb USING (gene) WHERE cb.i BETWEEN beg AND stop GROUP BY gene, beg, stop HAVING count(*) >= 2 AND avg(r) <= 0.65""")
def cusum_events(s, d):
    return folds.cusum_events(D.with_baseline(cusum_bins(s, d)), ["gene"], h=1.0, min_bins=2)


SUMMARY = "sm AS (SELECT gene, count(*) AS sites, median(depth) AS median_depth, avg(depth) AS mean_depth FROM v_depth GROUP BY 1)"


@query(f"WITH {SUMMARY} SELECT gene, pos, depth, CASE WHEN median_depth <> 0 THEN depth / median_depth END AS by_median, CASE WHEN mean_depth <> 0 THEN depth / mean_depth END AS by_mean FROM v_depth JOIN sm USING (gene)")
def base_ratio(s, d):
    return D.base_ratios(view(s, d, "v_depth"))


@query(f"WITH {SUMMARY} SELECT * FROM sm")
def base_summary(s, d):
    return D.base_summary(view(s, d, "v_depth"))


USED = "u AS (SELECT * FROM v_reads WHERE flag & 1 = 1 AND flag & 3844 = 0 AND mapq >= 20)"
ENTRIES = f"""{USED}, x AS (SELECT *, string_split(trim(unnest(string_split(sa, ';'))), ',') AS f FROM u WHERE sa IS NOT NULL),
en AS (SELECT sample, qname, flag, chrom, pos, mapq, cigar, f[1] AS sa_chrom, f[2]::BIGINT AS sa_pos, f[3] AS sa_strand, f[4] AS sa_cigar, f[5]::INT AS sa_mapq, f[6]::INT AS sa_nm FROM x WHERE len(f) = 6)"""


@query(f"WITH {ENTRIES} SELECT sample, qname, sa_chrom, sa_pos, sa_strand, sa_cigar, sa_mapq, sa_nm FROM en")
def sa_entries(s, d):
    return R.sa_entries(R.used(view(s, d, "v_reads"), R.SPLIT, 20)).select("sample", "qname", "sa_chrom", "sa_pos", "sa_strand", "sa_cigar", "sa_mapq", "sa_nm")


GAPS = f"""{ENTRIES}, y AS (SELECT *, pos + {LENGTH} - 1 AS e1, sa_pos + {LENGTH.replace("cigar", "sa_cigar")} - 1 AS e2 FROM en WHERE sa_mapq >= 20),
z AS (SELECT *, CASE WHEN pos <= sa_pos THEN e1 ELSE e2 END AS left_bp, CASE WHEN pos <= sa_pos THEN sa_pos ELSE pos END AS right_bp FROM y),
gp AS (SELECT *, CASE WHEN chrom <> sa_chrom THEN 'Interchromosomal' WHEN left_bp < right_bp - 1 THEN 'Deletion_Gap' WHEN left_bp = right_bp - 1 THEN 'Adjacent_No_Gap' ELSE 'Overlap_or_Complex' END AS junction FROM z)"""


def _gaps(s, d):
    return R.sa_gaps(R.sa_entries(R.used(view(s, d, "v_reads"), R.SPLIT, 20)), 20)


@query(f"WITH {GAPS} SELECT sample, qname, chrom, sa_chrom, left_bp, right_bp, junction, CASE WHEN junction = 'Deletion_Gap' THEN left_bp + 1 END AS sv_start, CASE WHEN junction = 'Deletion_Gap' THEN right_bp - 1 END AS sv_end FROM gp")
def sa_gaps(s, d):
    return _gaps(s, d).select("sample", "qname", "chrom", "sa_chrom", "left_bp", "right_bp", "junction", "sv_start", "sv_end")


@query(f"WITH {GAPS} SELECT junction, count(*) AS n FROM gp GROUP BY 1")
def sa_counters(s, d):
    return _gaps(s, d).groupBy("junction").agg(F.count("*").alias("n"))


def _greedy(source: str, window: int, prefix: str) -> str:
    """SQL of the greedy clusters: a step for each event of (sample, chrom) in order, with the current cluster's starts and ends."""
    near = lambda c, l: f"abs(g.{c} - floor(list_aggregate({l}, 'median') + 0.5)) <= {window}"
    return f"""gi AS (SELECT *, row_number() OVER (PARTITION BY sample, chrom ORDER BY sv_start, sv_end, tie) AS i FROM {source}),
gf AS (SELECT sample, chrom, i, 1 AS lab, [sv_start] AS a, [sv_end] AS b FROM gi WHERE i = 1
  UNION ALL SELECT sample, chrom, i, CASE WHEN ok THEN lab ELSE lab + 1 END, CASE WHEN ok THEN list_append(a, x) ELSE [x] END, CASE WHEN ok THEN list_append(b, y) ELSE [y] END
  FROM (SELECT g.sample, g.chrom, g.i, lab, a, b, g.sv_start AS x, g.sv_end AS y, {near("sv_start", "a")} AND {near("sv_end", "b")} AS ok FROM gf JOIN gi g ON g.sample = gf.sample AND g.chrom = gf.chrom AND g.i = gf.i + 1)),
gn AS (SELECT *, row_number() OVER (ORDER BY sample, substr(chrom, 4)::INT, lab) AS no FROM (SELECT DISTINCT sample, chrom, lab FROM gf)),
gm AS (SELECT gi.*, '{prefix}_' || lpad(no::VARCHAR, 6, '0') AS cluster_id FROM gi JOIN gf USING (sample, chrom, i) JOIN gn USING (sample, chrom, lab))"""


def _summary(least: int, counts: list[str], more: str = "") -> str:
    tally = "".join(f", t_{c} AS (SELECT cluster_id, string_agg({c} || ':' || n, ',' ORDER BY {c}) AS {c}_count FROM (SELECT cluster_id, {c}, count(*) AS n FROM gm GROUP BY 1, 2) GROUP BY 1)" for c in counts)
    return f"""{tally[2:]}, ag AS (SELECT sample, chrom, cluster_id, count(DISTINCT qname) AS support_reads, count(*) AS support_records, floor(median(sv_start) + 0.5)::BIGINT AS start_median, floor(median(sv_end) + 0.5)::BIGINT AS end_median,
  min(sv_start) || '-' || max(sv_start) AS start_range, min(sv_end) || '-' || max(sv_end) AS end_range, avg(sv_length) AS length_mean, min(sv_length) || '-' || max(sv_length) AS length_range, string_agg(DISTINCT qname, ',' ORDER BY qname) AS read_names{more},
  CASE WHEN count(DISTINCT qname) >= {least} THEN 'Pass' ELSE 'LowSupport' END AS status FROM gm GROUP BY 1, 2, 3), su AS (SELECT * FROM ag {" ".join(f"JOIN t_{c} USING (cluster_id)" for c in counts)})"""


SPLIT = f"""{GAPS}, ev AS (SELECT *, left_bp + 1 AS sv_start, right_bp - 1 AS sv_end, right_bp - left_bp - 1 AS sv_length, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand, {{tie}} AS tie FROM gp WHERE junction = 'Deletion_Gap' AND left_bp >= 0
  QUALIFY row_number() OVER (PARTITION BY sample, qname, chrom, pos, e1, cigar, sa_chrom, sa_pos, e2, sa_cigar, left_bp, right_bp ORDER BY flag, sa_mapq, sa_strand) = 1)""".replace("{tie}", "(qname, pos, sa_pos, cigar, sa_cigar)")
SPLIT_MEMBERS = f"{SPLIT}, {_greedy('ev', 20, 'SR_CLUSTER')}"
SPLIT_CLUSTERS = f"{SPLIT_MEMBERS}, {_summary(2, ['strand', 'sa_chrom', 'sa_strand'])}"


def _split_members(s, d):
    cols = ["sample", "qname", "chrom", "pos", "cigar", "sa_chrom", "sa_pos", "sa_cigar", "sv_start", "sv_end", "sv_length", "strand", "sa_strand"]
    return folds.greedy_clusters(R.split_events(_gaps(s, d)).select(*cols), ["sample", "chrom"], ["qname", "pos", "sa_pos", "cigar", "sa_cigar"], 20, "SR_CLUSTER", key_order=["sample", G.chrom_rank(F.col("chrom")), "chrom"])


MEMBER = ["sample", "qname", "chrom", "sv_start", "sv_end", "sv_length", "strand", "sa_strand", "cluster_id", "cluster_status"]


@query(f"WITH RECURSIVE {SPLIT_CLUSTERS} SELECT sample, qname, chrom, sv_start, sv_end, sv_length, strand, sa_strand, cluster_id, su.status AS cluster_status FROM gm JOIN su USING (sample, chrom, cluster_id)")
def split_members(s, d):
    members = _split_members(s, d)
    return R.with_status(members, R.cluster_summary(members, 2)).select(*MEMBER)


@query(f"WITH RECURSIVE {SPLIT_CLUSTERS} SELECT * FROM su")
def split_clusters(s, d):
    return R.cluster_summary(_split_members(s, d), 2)


@query(f"WITH RECURSIVE {SPLIT_CLUSTERS} SELECT * FROM su WHERE status = 'Pass'")
def split_pass(s, d):
    return split_clusters(s, d).filter("status = 'Pass'")


@query(f"WITH RECURSIVE {SPLIT_CLUSTERS} SELECT * FROM su WHERE status <> 'Pass'")
def split_failed(s, d):
    return split_clusters(s, d).filter("status <> 'Pass'")


@query(f"WITH RECURSIVE {SPLIT_CLUSTERS} SELECT kind, count(su.status) AS n, coalesce(sum(support_reads), 0)::BIGINT AS support_reads FROM (SELECT unnest(['All', 'Pass', 'Failed']) AS kind) LEFT JOIN su ON kind = 'All' OR (kind = 'Pass') = (su.status = 'Pass') GROUP BY 1")
def split_tee(s, d):
    """Clusters written once by status; each table is read back from its part."""
    clusters, folder = split_clusters(s, d), f"{shared_folder(s)}/clusters-{uuid.uuid4().hex}"
    tee.write_tee(clusters, folder)
    kinds = [tee.read_tee(s, folder, clusters.schema, k).agg(F.lit(k).alias("kind"), F.count("*").alias("n"), F.coalesce(F.sum("support_reads"), F.lit(0)).alias("support_reads")) for k in (tee.ALL, tee.PASS, tee.FAILED)]
    return kinds[0].union(kinds[1]).union(kinds[2])


@query("""WITH n AS (SELECT path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, regexp_extract(path, '[^/]*$') AS name FROM v_files),
m AS (SELECT *, regexp_matches(name, '\\.(fastq|fq)(\\.gz)?$', 'i') AS fq, regexp_matches(name, '(^|[._-])R?1([._-]|$)', 'i') AS one, regexp_matches(name, '(^|[._-])R?2([._-]|$)', 'i') AS two FROM n),
g AS (SELECT folder, count(*) FILTER (fq AND one) AS n_r1, count(*) FILTER (fq AND NOT one AND two) AS n_r2, min(path) FILTER (fq AND one) AS a, min(path) FILTER (fq AND NOT one AND two) AS b FROM m GROUP BY 1)
SELECT folder, n_r1, n_r2, CASE WHEN n_r1 = 1 AND n_r2 = 1 THEN a END AS r1, CASE WHEN n_r1 = 1 AND n_r2 = 1 THEN b END AS r2, CASE WHEN n_r1 = 1 AND n_r2 = 1 THEN 'Paired' WHEN n_r1 > 1 OR n_r2 > 1 THEN 'Multiple' ELSE 'Missing' END AS found FROM g""")
def fastq_pairs(s, d):
    return listing.fastq_pairs(listing.with_names(view(s, d, "v_files")))


PAIRS = f"""v AS (SELECT * FROM v_reads WHERE flag & 1 = 1 AND flag & 3852 = 0 AND mapq >= 20 AND rnext = '=' AND tlen >= 500 AND flag & 16 = 0 AND flag & 32 <> 0),
pr AS (SELECT sample, qname, chrom, tlen, 'FR' AS orientation, pos + {LENGTH} AS sv_start, pnext - 1 AS sv_end FROM v)"""


@query(f"WITH {PAIRS} SELECT DISTINCT sample, qname, chrom, tlen, orientation, sv_start, sv_end, sv_end - sv_start + 1 AS sv_length FROM pr WHERE sv_start <= sv_end")
def discordant_pairs(s, d):
    return R.discordant_pairs(view(s, d, "v_reads")).select("sample", "qname", "chrom", "tlen", "orientation", "sv_start", "sv_end", "sv_length")


PAIR_CLUSTERS = f"""{PAIRS}, dq AS (SELECT DISTINCT sample, qname, chrom, tlen, orientation, sv_start, sv_end, sv_end - sv_start + 1 AS sv_length, '+' AS strand, '-' AS mate_strand, (qname, tlen) AS tie FROM pr WHERE sv_start <= sv_end),
{_greedy("dq", 500, "DR_CLUSTER")}, {_summary(3, ["strand", "mate_strand"], ", median(tlen) AS insert_median, avg(tlen) AS insert_mean, min(tlen) || '-' || max(tlen) AS insert_range, 'FR:' || count(*) AS orientations")}"""


@query(f"WITH RECURSIVE {PAIR_CLUSTERS} SELECT * FROM su")
def discordant_clusters(s, d):
    pairs = R.discordant_pairs(view(s, d, "v_reads")).select("sample", "qname", "chrom", "tlen", "orientation", "sv_start", "sv_end", "sv_length", "strand", "mate_strand")
    members = folds.greedy_clusters(pairs, ["sample", "chrom"], ["qname", "tlen"], 500, "DR_CLUSTER", key_order=["sample", G.chrom_rank(F.col("chrom")), "chrom"])
    return R.cluster_summary(members, 3, insert=True)


TLEN = "t AS (SELECT sample, qname, tlen FROM v_reads WHERE flag & 2 = 2 AND flag & 3340 = 0 AND mapq >= 20 AND tlen > 0)"


@query(f"""WITH {TLEN}, m AS (SELECT sample, median(tlen) AS med FROM t GROUP BY 1), x AS (SELECT t.*, med, abs(tlen - med) AS dev FROM t JOIN m USING (sample))
SELECT sample, count(*) AS n, avg(tlen) AS mean, stddev_samp(tlen) AS sd, any_value(med) AS median, median(dev) AS mad, quantile_cont(tlen, 0.25) AS q1, quantile_cont(tlen, 0.75) AS q3, quantile_cont(tlen, 0.95) AS p95,
  quantile_cont(tlen, 0.99) AS p99, quantile_cont(tlen, 0.995) AS p995, any_value(med) + 3 * 1.4826 * median(dev) AS threshold FROM x GROUP BY 1""")
def tlen_stats(s, d):
    return R.tlen_stats(R.valid_tlen(view(s, d, "v_reads")))


QUANTILES = {"least": 0.0, "p01": 0.01, "q1": 0.25, "mid": 0.5, "q3": 0.75, "p99": 0.99, "most": 1.0}


@query(f"""SELECT l_partkey % 1000 AS part_group, l_returnflag AS flag, count(*) AS n, {", ".join(f"round(quantile_cont(l_extendedprice, {f}), 4) AS {n}" for n, f in QUANTILES.items())} FROM lineitem GROUP BY 1, 2""")
def price_quantiles(s, d):
    rows = s.read.parquet(f"{d}/lineitem.parquet").select((F.col("l_partkey") % 1000).alias("part_group"), F.col("l_returnflag").alias("flag"), "l_extendedprice")
    found = exact_quantiles(rows, ["part_group", "flag"], "l_extendedprice", QUANTILES)
    return found.withColumns({c: F.round(c, 4) for c in QUANTILES})  # cents, interpolated in hundredths


@query(f"WITH {TLEN} SELECT * FROM t ORDER BY md5(concat_ws('|', sample, qname, tlen, '20260701')), sample, qname, tlen LIMIT 1000")
def tlen_sample(s, d):
    return R.tlen_sample(R.valid_tlen(view(s, d, "v_reads")), 1000)


COVER = """pd AS (SELECT s.id, s.start, s."end", d.start2, d.end2, greatest(s.start, d.start2) AS a, least(s."end", d.end2) AS b FROM v_split s JOIN v_depth_iv d ON s.sample = d.sample AND s.chrom = d.chrom AND s.start <= d.end2 AND s."end" >= d.start2),
pt AS (SELECT *, max(b) OVER (PARTITION BY id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM pd),
cv AS (SELECT id, sum(greatest(0, b - greatest(a, coalesce(top, a - 1) + 1) + 1))::BIGINT AS covered FROM pt GROUP BY 1),
dl AS (SELECT id, count(*) AS depth_records FROM pd GROUP BY 1),
dr AS (SELECT id, string_agg(r, ',' ORDER BY start2, end2) AS depth_range FROM (SELECT DISTINCT id, start2, end2, start2 || '-' || end2 AS r FROM pd) GROUP BY 1),
ds AS (SELECT s.*, coalesce(covered, 0) AS depth_bases, coalesce(covered, 0)::DOUBLE / (s."end" - s.start + 1) AS depth_fraction, coalesce(covered, 0)::DOUBLE / (s."end" - s.start + 1) >= 0.9 AS depth_support, coalesce(depth_records, 0) AS depth_records, depth_range
  FROM v_split s LEFT JOIN cv USING (id) LEFT JOIN dl USING (id) LEFT JOIN dr USING (id))"""
DISC = """dp AS (SELECT s.id, d.did, least(s."end", d.end2) - greatest(s.start, d.start2) + 1 AS o, (least(s."end", d.end2) - greatest(s.start, d.start2) + 1)::DOUBLE / (s."end" - s.start + 1) AS f
  FROM v_split s JOIN v_disc_iv d ON s.sample = d.sample AND s.chrom = d.chrom AND s.start <= d.end2 AND s."end" >= d.start2),
da AS (SELECT id, max(o) AS o, max(f) AS f, count(*) FILTER (f >= 0.9) AS n, string_agg(DISTINCT did, ',' ORDER BY did) FILTER (f >= 0.9) AS ids FROM dp GROUP BY 1),
dc AS (SELECT s.id, coalesce(o, 0) AS disc_bases, coalesce(f, 0)::DOUBLE AS disc_fraction, coalesce(f, 0) >= 0.9 AS disc_support, coalesce(n, 0) AS disc_records, ids AS disc_ids FROM v_split s LEFT JOIN da USING (id))"""
MERGE = f"""{COVER}, {DISC}, mg AS (SELECT ds.*, disc_bases, disc_fraction, disc_support, disc_records, disc_ids, (1 + depth_support::INT + disc_support::INT)::INT AS evidence_count,
  CASE WHEN depth_support AND disc_support THEN 'High' WHEN depth_support THEN 'Moderate' ELSE 'Low' END AS evidence_level,
  CASE WHEN depth_support AND disc_support THEN 'High' WHEN depth_support THEN 'Moderate' ELSE 'Low' END || '_confidence_candidate' AS candidate_status, "end" - start + 1 AS size,
  CASE WHEN depth_support AND disc_support THEN 'Split candidate supported by depth and discordant evidence' WHEN depth_support THEN 'Split candidate supported by depth only; no discordant interval covers >= 0.9 of split interval'
    ELSE 'Split candidate lacks >= 0.9 depth coverage; confidence forced to Low' END AS comment,
  'Split' || CASE WHEN depth_support THEN ',Depth' ELSE '' END || CASE WHEN disc_support THEN ',Discordant' ELSE '' END AS evidence_types FROM ds JOIN dc USING (id))"""


@query(f"WITH {COVER} SELECT * FROM ds")
def depth_support(s, d):
    return E.depth_support(view(s, d, "v_split"), view(s, d, "v_depth_iv"))


@query(f"WITH {DISC} SELECT * FROM dc")
def discordant_support(s, d):
    return E.discordant_support(view(s, d, "v_split"), view(s, d, "v_disc_iv"))


@query(f"WITH {MERGE} SELECT * FROM mg")
def merge_evidence(s, d):
    return E.merge_evidence(view(s, d, "v_split"), view(s, d, "v_depth_iv"), view(s, d, "v_disc_iv"))


# What counts of evidence as callers give it, with intervals turned and chromosomes named alike.
COUNTED = """us AS (SELECT id, sample, chrom, least(start, "end") AS start, greatest(start, "end") AS "end", status FROM v_split_raw WHERE nullif(status, 'NA') IS NULL OR lower(status) = 'pass'),
ud AS (SELECT sample, CASE WHEN chrom LIKE 'chr%' THEN chrom ELSE 'chr' || chrom END AS chrom, least(start2, end2) AS start2, greatest(start2, end2) AS end2 FROM v_depth_raw WHERE svtype IS NULL OR lower(svtype) LIKE '%del%'),
up AS (SELECT did, sample, CASE WHEN chrom LIKE 'chr%' THEN chrom ELSE 'chr' || chrom END AS chrom, least(start2, end2) AS start2, greatest(start2, end2) AS end2 FROM v_disc_raw WHERE status IS NULL OR NOT regexp_matches(lower(status), 'discard|fail|low'))"""
MERGE_RAW = f"{COUNTED}, {MERGE.replace('v_split', 'us').replace('v_depth_iv', 'ud').replace('v_disc_iv', 'up')}"


@query(f"WITH {MERGE_RAW} SELECT * FROM mg")
def merge_given_evidence(s, d):
    return E.merge_evidence(view(s, d, "v_split_raw"), view(s, d, "v_depth_raw"), view(s, d, "v_disc_raw"))


@query(f"WITH {MERGE_RAW} SELECT evidence_level, evidence_types, status, count(*) AS n FROM mg GROUP BY 1, 2, 3")
def given_level_counts(s, d):
    """Levels need no lists, so none are made."""
    found = E.evidence_levels(view(s, d, "v_split_raw"), view(s, d, "v_depth_raw"), view(s, d, "v_disc_raw"), ("status",))
    return found.groupBy("evidence_level", "evidence_types", "status").agg(F.count("*").alias("n"))


# Every column of merged candidates: lists in the order of coordinates, then names.
TABLE = f"""{MERGE_RAW}, gd AS (SELECT id, gene, support_reads, support_records FROM v_split_given),
fd AS (SELECT sample, chrom AS shown, CASE WHEN chrom LIKE 'chr%' THEN chrom ELSE 'chr' || chrom END AS chrom, least(start2, end2) AS start2, greatest(start2, end2) AS end2, coalesce(nullif(depth_id, 'NA'), 'Depth_' || line) AS source FROM v_depth_raw WHERE svtype IS NULL OR lower(svtype) LIKE '%del%'),
fp AS (SELECT did AS source, sample, chrom AS shown, CASE WHEN chrom LIKE 'chr%' THEN chrom ELSE 'chr' || chrom END AS chrom, least(start2, end2) AS start2, greatest(start2, end2) AS end2, nullif(discordant_reads, 'NA') AS reads, nullif(median_insert, 'NA') AS ins
  FROM v_disc_raw WHERE status IS NULL OR NOT regexp_matches(lower(status), 'discard|fail|low')),
od AS (SELECT DISTINCT us.id, start2, end2, shown, source, shown || ':' || start2 || '-' || end2 AS place FROM us JOIN fd ON us.sample = fd.sample AND us.chrom = fd.chrom AND us.start <= end2 AND us."end" >= start2),
oh AS (SELECT us.id, start2, end2, shown, source, reads, ins, shown || ':' || start2 || '-' || end2 AS place FROM us JOIN fp ON us.sample = fp.sample AND us.chrom = fp.chrom AND us.start <= end2 AND us."end" >= start2
  WHERE (least(us."end", end2) - greatest(us.start, start2) + 1)::DOUBLE / (us."end" - us.start + 1) >= 0.9),
nh AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY start2, end2, shown, source, ins) AS rn FROM oh),
td AS (SELECT id, string_agg('Depth:' || source || ':' || place, ',' ORDER BY start2, end2, shown, source) AS labels FROM od GROUP BY 1),
tr AS (SELECT id, string_agg(place, ',' ORDER BY start2, end2, shown) AS ranges FROM (SELECT DISTINCT id, start2, end2, shown, place FROM od) GROUP BY 1),
hr AS (SELECT id, string_agg(v, ',' ORDER BY rn) AS ranges FROM (SELECT id, place AS v, min(rn) AS rn FROM nh GROUP BY 1, 2) GROUP BY 1),
hl AS (SELECT id, string_agg(v, ',' ORDER BY rn) AS labels FROM (SELECT id, 'Discordant:' || source || ':' || place AS v, min(rn) AS rn FROM nh GROUP BY 1, 2) GROUP BY 1),
hc AS (SELECT id, string_agg(v, ',' ORDER BY rn) AS ids FROM (SELECT id, source AS v, min(rn) AS rn FROM nh GROUP BY 1, 2) GROUP BY 1),
hi AS (SELECT id, string_agg(v, ',' ORDER BY rn) AS inserts FROM (SELECT id, ins AS v, min(rn) AS rn FROM nh WHERE ins IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
hs AS (SELECT id, sum(v) AS n_reads FROM (SELECT id, source, arg_min(try_cast(reads AS DOUBLE), reads) AS v FROM oh GROUP BY 1, 2) GROUP BY 1),
mt32 AS (SELECT sample AS "SampleID", nullif(gene, 'NA') AS "Gene", chrom AS "Chrom", id AS "Cluster_ID", start AS "Split_Start", "end" AS "Split_End", size AS "Split_Size", support_reads AS "Split_Reads", support_records AS "Split_Records",
  CASE WHEN depth_support THEN 'Yes' ELSE 'No' END AS "Depth_Support", depth_bases AS "Depth_Covered_Bases", printf('%.4f', depth_fraction) AS "Depth_Coverage_Fraction", depth_records AS "Depth_Record_Count", tr.ranges AS "Depth_Range",
  CASE WHEN disc_support THEN 'Yes' ELSE 'No' END AS "Discordant_Read_Support", disc_bases AS "Discordant_Overlap_Bases", printf('%.4f', disc_fraction) AS "Discordant_Overlap_Fraction", disc_records AS "Discordant_Record_Count",
  hr.ranges AS "Discordant_Range", hc.ids AS "Discordant_Cluster_IDs", n_reads AS "Discordant_Reads", inserts AS "Median_Insert_Size", evidence_count AS "Evidence_Count", evidence_level AS "Evidence_Level", evidence_types AS "Evidence_Types",
  start AS "Best_Start", "end" AS "Best_End", size AS "Best_Size", 'Split' AS "Best_Evidence", candidate_status AS "Candidate_Status",
  concat_ws(',', 'Split:' || id || ':' || chrom || ':' || start || '-' || "end", td.labels, hl.labels) AS "Source_Records", comment AS "Comment"
  FROM mg JOIN gd USING (id) LEFT JOIN td USING (id) LEFT JOIN tr USING (id) LEFT JOIN hr USING (id) LEFT JOIN hl USING (id) LEFT JOIN hc USING (id) LEFT JOIN hi USING (id) LEFT JOIN hs USING (id))"""


@query(f"WITH {TABLE} SELECT * FROM mt32")
def merged_candidates(s, d):
    return candidates.merged_table(view(s, d, "v_split_given"), view(s, d, "v_depth_raw"), view(s, d, "v_disc_raw"))


@query(f"WITH {MERGE} SELECT evidence_level, count(*) AS n FROM mg GROUP BY 1")
def level_counts(s, d):
    """Levels need no lists, so none are made."""
    found = E.evidence_levels(view(s, d, "v_split"), view(s, d, "v_depth_iv"), view(s, d, "v_disc_iv"))
    return found.groupBy("evidence_level").agg(F.count("*").alias("n"))


HITS = """h AS (SELECT c.id, e.chrom AS ec, least(c."end", e."end") - greatest(c.start, e.start) + 1 AS o, e.gene, e.transcript, e.exon, e.start AS s2, e."end" AS e2, (least(c."end", e."end") - greatest(c.start, e.start) + 1)::DOUBLE / (e."end" - e.start + 1) AS part
  FROM v_split c JOIN v_exons e ON c.chrom = e.chrom AND c.start <= e."end" AND c."end" >= e.start),
k AS (SELECT *, gene || '|' || transcript || '|EX' || exon AS label FROM h WHERE part >= 0.2),
ls AS (SELECT id, string_agg(label, ',' ORDER BY s2, e2, gene, transcript, exon) AS exons, count(*) AS n_exons, string_agg(label, ',' ORDER BY s2, e2, gene, transcript, exon) FILTER (part >= 1) AS full_exons,
  string_agg(label, ',' ORDER BY s2, e2, gene, transcript, exon) FILTER (part < 1) AS partial_exons, string_agg(label || ':' || ec || ':' || s2 || ':' || e2 || ':overlap=' || o || ':fraction=' || printf('%.3f', part), ';' ORDER BY s2, e2, gene, transcript, exon) AS exon_detail FROM k GROUP BY 1),
mo AS (SELECT id, gene, count(*) AS n FROM k GROUP BY 1, 2), tg AS (SELECT id, gene FROM mo QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, gene) = 1),
mt AS (SELECT id, transcript, count(*) AS n FROM k GROUP BY 1, 2), tt AS (SELECT id, transcript FROM mt QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, transcript) = 1)"""


def _exons(s, d):
    return view(s, d, "v_exons").withColumnsRenamed({"start": "start2", "end": "end2"}).drop("strand")


@query(f"""WITH {MERGE}, {HITS} SELECT mg.*, exons, coalesce(n_exons, 0) AS n_exons, CASE WHEN n_exons > 0 THEN coalesce(full_exons, '') END AS full_exons, CASE WHEN n_exons > 0 THEN coalesce(partial_exons, '') END AS partial_exons, exon_detail, gene, transcript, CASE WHEN n_exons > 0 THEN 'Annotated' ELSE 'Not_annotated' END AS annotation, chrom || ':' || start || '-' || "end" AS region
FROM mg LEFT JOIN ls USING (id) LEFT JOIN tg USING (id) LEFT JOIN tt USING (id)""")
def annotate(s, d):
    """Exons and evidence are read in one pass."""
    return E.merge_evidence(view(s, d, "v_split"), view(s, d, "v_depth_iv"), view(s, d, "v_disc_iv"), exons=_exons(s, d))


#: Exons of one of the five chromosomes are left out, so that it has no annotation.
FOUR_CHROMS = "ex4 AS (SELECT * FROM v_exons WHERE chrom <> 'chr5')"


@query(f"""WITH {FOUR_CHROMS}, {TABLE}, {HITS.replace("v_split", "us").replace("v_exons", "ex4")}
SELECT "SampleID", mt32."Gene", "Chrom", "Best_Start" AS "Start", "Best_End" AS "End", "Chrom" || ':' || "Best_Start" || '-' || "Best_End" AS "Candidate_Region", "Best_Size" AS "Size_bp", 'Best' AS "Coordinate_Source", "Cluster_ID", "Split_Start", "Split_End", "Split_Size",
  'Yes' AS "Split_Read_Support", "Split_Reads" AS "Split_Read_Count", "Split_Records" AS "Split_Record_Count", "Depth_Support", "Depth_Covered_Bases", "Depth_Coverage_Fraction", "Depth_Record_Count", "Depth_Range", "Discordant_Read_Support", "Discordant_Overlap_Bases",
  "Discordant_Overlap_Fraction", "Discordant_Record_Count", "Discordant_Range", "Discordant_Cluster_IDs", "Discordant_Reads", "Median_Insert_Size", "Evidence_Level", "Evidence_Types", "Evidence_Count", "Best_Evidence", "Candidate_Status", "Source_Records", "Comment",
  tg.gene AS "Annotated_Gene", tt.transcript AS "Annotated_Transcript", exons AS "Affected_Exons", coalesce(n_exons, 0)::INT AS "Overlap_Exon_Count", full_exons AS "Fully_Covered_Exons", partial_exons AS "Partially_Overlapped_Exons",
  CASE WHEN n_exons > 0 THEN 'Annotated' ELSE 'Not_annotated' END AS "Annotation_Status", CASE WHEN n_exons > 0 THEN exon_detail WHEN "Chrom" IN (SELECT chrom FROM ex4) THEN 'No exon overlapped' ELSE 'No exon annotation on chromosome ' || "Chrom" END AS "Exon_Overlap_Detail"
FROM mt32 LEFT JOIN ls ON ls.id = "Cluster_ID" LEFT JOIN tg ON tg.id = "Cluster_ID" LEFT JOIN tt ON tt.id = "Cluster_ID"
""")
def annotated_candidates(s, d):
    """Exons and evidence are read in one pass."""
    exons = _exons(s, d).filter("chrom <> 'chr5'")
    return candidates.annotated_table(candidates.merged_table(view(s, d, "v_split_given"), view(s, d, "v_depth_raw"), view(s, d, "v_disc_raw"), exons=exons), None)


@query(f"WITH {HITS} SELECT id, gene FROM tg")
def affected_gene_mode(s, d):
    return E.annotate(view(s, d, "v_split"), _exons(s, d)).filter("gene is not null").select("id", "gene")


@query("""WITH n AS (SELECT *, lag(exon) OVER w AS prev_exon, lead(exon) OVER w AS next_exon, lag("end") OVER w AS pe, lead(start) OVER w AS ns FROM v_exons WINDOW w AS (PARTITION BY gene, transcript, chrom ORDER BY start, "end", exon))
SELECT * EXCLUDE (pe, ns), CASE WHEN prev_exon IS NOT NULL THEN greatest(0, start - pe - 1) END AS left_intron, CASE WHEN next_exon IS NOT NULL THEN greatest(0, ns - "end" - 1) END AS right_intron,
  CASE strand WHEN '+' THEN prev_exon WHEN '-' THEN next_exon END AS upstream_exon, CASE strand WHEN '+' THEN next_exon WHEN '-' THEN prev_exon END AS downstream_exon FROM n""")
def exon_intron(s, d):
    return regions.exon_intron(view(s, d, "v_exons"))


MANE = "me AS (SELECT g.*, mane_gene FROM v_gtf g JOIN v_mane m USING (transcript) WHERE coalesce(gene_name, '') = '' OR gene_name = mane_gene)"


@query(f"WITH {MANE} SELECT * FROM me")
def mane_exons(s, d):
    return regions.mane_exons(view(s, d, "v_gtf"), view(s, d, "v_mane"))


@query(f'WITH {MANE} SELECT mane_gene, transcript, chrom, strand, min(start) AS start, max("end") AS "end", count(*) AS exon_count FROM me GROUP BY 1, 2, 3, 4')
def gene_ranges(s, d):
    return regions.gene_ranges(mane_exons(s, d))


@query(f"WITH {MANE} SELECT * FROM v_mane WHERE transcript NOT IN (SELECT transcript FROM me)")
def unmatched(s, d):
    return regions.unmatched(view(s, d, "v_mane"), mane_exons(s, d))


@query("""WITH b AS (SELECT e.gene, unnest(generate_series(e.start, e."end")) AS p, e.start AS l, e."end" AS r FROM (SELECT DISTINCT gene, start, "end" FROM v_exons) e),
c AS (SELECT DISTINCT gene, unnest(generate_series(start, "end")) AS p FROM v_genes), k AS (SELECT b.* FROM b ANTI JOIN c USING (gene, p)),
i AS (SELECT *, p - row_number() OVER (PARTITION BY gene, l, r ORDER BY p) AS g FROM k) SELECT gene, min(p) AS start, max(p) AS "end" FROM i GROUP BY gene, l, r, g""")
def utr_subtract(s, d):
    left = view(s, d, "v_exons").select("gene", "start", "end").distinct()
    right = view(s, d, "v_genes").select("gene", F.col("start").alias("start2"), F.col("end").alias("end2"))
    return intervals.subtract_intervals(left, right, "gene")


def _draw(tag: str, n: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', gene, transcript, length_bin, replicate, '{tag}', '1')), 1, 8))::BIGINT % ({n})"


def _genes(s, d):
    return gene_ranges(s, d).withColumnRenamed("mane_gene", "gene")


@query(f"""WITH {MANE}, gr AS (SELECT mane_gene AS gene, transcript, chrom, strand, min(start) AS gene_start, max("end") AS gene_end, count(*) AS exon_count FROM me GROUP BY 1, 2, 3, 4),
b AS (SELECT unnest({[n for n, _, _ in simulate.SIZE_BINS]}) AS length_bin, unnest({[a for _, a, _ in simulate.SIZE_BINS]})::BIGINT AS bin_min_size, unnest({[z for _, _, z in simulate.SIZE_BINS]})::BIGINT AS bin_max_size),
x AS (SELECT *, gene_end - gene_start + 1 AS gene_length FROM gr CROSS JOIN b CROSS JOIN (SELECT unnest([1, 2])::INT AS replicate) WHERE gene_length >= bin_min_size AND gene_length >= 150),
y AS (SELECT *, bin_min_size + {_draw("size", "least(bin_max_size, gene_length) - bin_min_size + 1")} AS del_size_bp FROM x),
z AS (SELECT *, gene_start + {_draw("start", "gene_length - del_size_bp + 1")} AS del_start, gene_length - del_size_bp AS del_haplotype_length, 'SIM_' || gene || '_DEL_' || length_bin || '_rep' || replicate AS sample FROM y WHERE gene_length - del_size_bp >= 150)
SELECT *, del_start + del_size_bp - 1 AS del_end, gene_length AS wt_haplotype_length, 30.0::DOUBLE AS depth, 15.0::DOUBLE AS wt_depth, 15.0::DOUBLE AS del_depth, 150 AS read_length, 350.0::DOUBLE AS insert_mean, 50.0::DOUBLE AS insert_sd, 0.0::DOUBLE AS error_rate,
  floor(15.0::DOUBLE * gene_length / 300 + 0.5)::BIGINT AS wt_fragment_number, floor(15.0::DOUBLE * del_haplotype_length / 300 + 0.5)::BIGINT AS del_fragment_number, {_draw("event", "2147483648")} AS seed,
  'simulated/' || sample || '/' || sample || '.R1.fastq' AS r1_fastq, 'simulated/' || sample || '/' || sample || '.R2.fastq' AS r2_fastq FROM z""")
def sim_truth(s, d):
    return simulate.sim_truth(_genes(s, d), simulate.SIZE_BINS, 2, 30.0, 150)


@query(f"""WITH {MANE} SELECT mane_gene AS gene, transcript, chrom, strand, min(start) AS start, max("end") AS "end", count(*) AS exon_count FROM me GROUP BY 1, 2, 3, 4 HAVING max("end") - min(start) + 1 >= 150 ORDER BY mane_gene, transcript LIMIT 20""")
def first_genes(s, d):
    return simulate.first_genes(_genes(s, d), 20, ["gene", "transcript"], 150)


PARTS = """tg AS (SELECT mane_gene AS gene, replace(arg_max(transcript, line), '.2', '') AS transcript FROM v_mane_lines WHERE mane_gene IN (SELECT gene FROM v_core) GROUP BY 1)"""


@query(f"""WITH {PARTS}, o AS (SELECT p.* FROM v_gtf_parts p JOIN tg USING (gene, transcript))
SELECT gene, transcript, min(chrom) AS chrom, min(strand) AS strand, coalesce(min(start) FILTER (feature = 'transcript'), min(start) FILTER (feature = 'exon')) AS tx_start, coalesce(max("end") FILTER (feature = 'transcript'), max("end") FILTER (feature = 'exon')) AS tx_end,
  count(*) FILTER (feature = 'exon') AS n_exons, count(*) FILTER (feature = 'CDS') AS n_cds, count(*) FILTER (feature = '5UTR') AS n_utr5, count(*) FILTER (feature = '3UTR') AS n_utr3,
  coalesce(string_agg(start || '-' || "end", ',' ORDER BY start, "end") FILTER (feature = 'exon'), '') AS exons, coalesce(string_agg(start || '-' || "end", ',' ORDER BY start, "end") FILTER (feature = 'CDS'), '') AS cds FROM o GROUP BY 1, 2""")
def gene_structures(s, d):
    return reports.gene_structures(view(s, d, "v_core"), view(s, d, "v_mane_lines"), view(s, d, "v_gtf_parts"))


@query(f"""WITH {PARTS} SELECT DISTINCT 'Missing_MANE' AS category, gene, 'Gene not found in RefSeq_MANE_Select file' AS reason FROM v_core WHERE gene NOT IN (SELECT gene FROM tg)
UNION ALL SELECT 'Missing_GTF', gene, 'MANE transcript not found in GTF' FROM tg ANTI JOIN v_gtf_parts USING (gene, transcript)""")
def missing_report(s, d):
    return reports.missing_report(view(s, d, "v_core"), view(s, d, "v_mane_lines"), view(s, d, "v_gtf_parts"))


def _windows(s, d):
    return window_ratio(s, d).withColumn("window_id", F.concat(F.lit("W"), F.col("number").cast("string")))


@query(f"WITH {RATIO} SELECT gene, 'W' || number AS window_id, w_start, w_end, ratio, status, row_number() OVER (PARTITION BY gene ORDER BY w_start, w_end, 'W' || number)::INT AS plot_index FROM st")
def plot_index(s, d):
    return reports.plot_index(_windows(s, d)).select("gene", "window_id", "w_start", "w_end", "ratio", "status", "plot_index")


@query(f"""WITH {RATIO}, nn AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY w_start, w_end, 'W' || number) AS place, 'W' || number || ': ' || coalesce(printf('%.3f', ratio), 'nan') AS line FROM st WHERE status <> 'Normal_window'),
nl AS (SELECT gene, count(*) AS n_labels, string_agg(line, chr(10) ORDER BY place) FILTER (place <= 30) AS lines FROM nn GROUP BY 1)
SELECT gene, count(*) AS n_windows, coalesce(any_value(n_labels), 0) AS n_labels, CASE WHEN any_value(n_labels) IS NULL THEN 'Non-normal windows: none' ELSE 'Non-normal windows' || chr(10) || any_value(lines) || CASE WHEN any_value(n_labels) > 30 THEN chr(10) || '... +' || (any_value(n_labels) - 30) || ' more' ELSE '' END END AS labels
FROM st LEFT JOIN nl USING (gene) GROUP BY gene""")
def window_labels(s, d):
    return reports.window_labels(_windows(s, d))


@query(f"WITH {RATIO} SELECT count(DISTINCT gene) AS n_genes FROM st")
def plotted_genes(s, d):
    return window_ratio(s, d).agg(F.count_distinct("gene").alias("n_genes"))


@query(f"""WITH pa AS (SELECT *, pos + {LENGTH} AS a, pnext - 1 AS b FROM v_reads),
pb AS (SELECT *, CASE WHEN pos < 1 OR pnext < 1 OR mapq < 20 THEN 'bad_sam' WHEN flag & 1 <> 1 OR flag & 3852 <> 0 THEN 'flag' WHEN rnext <> '=' AND rnext <> chrom THEN 'mate_chrom' WHEN tlen <= 0 THEN 'tlen_sign' WHEN tlen < 500 THEN 'insert_size'
  WHEN flag & 16 <> 0 OR flag & 32 = 0 THEN 'orientation' WHEN a > b THEN 'invalid_interval' END AS reason FROM pa),
pf AS (SELECT count(*) AS n, count(DISTINCT (sample, qname, chrom, pos, a, b, tlen)) AS once FROM pb WHERE reason IS NULL)
SELECT reason, count(*) AS n FROM pb WHERE reason IS NOT NULL GROUP BY 1 UNION ALL SELECT 'candidate_pairs', once FROM pf UNION ALL SELECT 'duplicate_pair', n - once FROM pf""")
def discordant_counters(s, d):
    return R.pair_counters(view(s, d, "v_reads"))


@query(f"""WITH {GAPS}, ge AS (SELECT *, CASE WHEN junction <> 'Deletion_Gap' THEN 'non_deletion' WHEN left_bp < 0 THEN 'invalid_coord' END AS reason FROM gp),
gf AS (SELECT count(*) AS n, count(DISTINCT (sample, qname, chrom, pos, e1, cigar, sa_chrom, sa_pos, e2, sa_cigar, left_bp, right_bp)) AS once FROM ge WHERE reason IS NULL)
SELECT reason, count(*) AS n FROM ge WHERE reason IS NOT NULL GROUP BY 1 UNION ALL SELECT 'used', once FROM gf UNION ALL SELECT 'duplicate_event', n - once FROM gf""")
def split_event_counters(s, d):
    return R.event_counters(_gaps(s, d))


@query(f"WITH {MANE} SELECT * FROM me")
def exon_rows(s, d):
    """The exon table in its order."""
    return reports.exon_order(mane_exons(s, d))


@query(f'WITH {MANE} SELECT mane_gene, transcript, chrom, strand, min(start) AS start, max("end") AS "end", count(*) AS exon_count FROM me GROUP BY 1, 2, 3, 4')
def gene_rows(s, d):
    """The gene table in its order."""
    return reports.by_place(gene_ranges(s, d), "mane_gene")
