"""The registered queries and their SQL: every operator over the driver's whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ionloom.constants import PROTON, RESIDUES, SCALE, WATER, mass_int
from ionloom.functions import naming, sequence
from ionloom.operators import candidates as C
from ionloom.operators import decoys, fdr, fragments, loop, membership, ptm, scan_scores, variable, xcorr
from ionloom.operators import features as FE
from ionloom.operators import precursors as P
from ionloom.params import SearchParams, XcorrParams
from ionloom.plans import views as V
from ionloom.plans.search import search_space
from ionloom.session import written
from ionloom.sources import layout, sinks
from ionloom.sources.tables import run_listing
from ionloom.streaming import runner

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

PPM = 500
#: Largest integer mass of the library's windows (part prices stay below 2,100).
MAX_MASS = 2_200 * SCALE
#: Rows of the output that one task makes from far smaller inputs.
ROWS_A_TASK = 2_000_000
#: Scans whose rows of one FASTA entry come at once; the dictionary of a Parquet column has room for them.
SCANS_A_BLOCK = 2048
WIDTH = C.bin_width(MAX_MASS, PPM, PPM)
BINS = XcorrParams(bin_size=1.0005, use_flanking_peaks=True, max_fragment_charge=1)


def query(sql: str | None = None, name: str | None = None):
    """Registers a function (spark, sf_dir) and, if there is one, its SQL."""

    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = sql
        return f

    return add


# precursors

_CHARGES = f"SELECT event_id AS scan, mz, CAST(z AS BIGINT) AS charge FROM (SELECT event_id, value AS mz, unnest(CASE WHEN event_type = 'view' THEN [2,3,4,5,6] ELSE [2 + user_id % 5] END) AS z FROM events)"


@query(f"SELECT scan, charge, round(mass, 6) AS mass FROM ({V.PRECURSOR})")
def precursor_mass(spark: SparkSession, d: str) -> DataFrame:
    return V.precursor(spark, d).select("scan", "charge", F.round("mass", 6).alias("mass"))


@query(f"SELECT scan, mass_int FROM ({V.PRECURSOR})")
def precursor_mass_int(spark: SparkSession, d: str) -> DataFrame:
    return V.precursor(spark, d).select("scan", "mass_int")


@query(_CHARGES)
def charge_default_explode(spark: SparkSession, d: str) -> DataFrame:
    e = V.table(spark, d, "events")
    z = F.when(F.col("event_type") != "view", (F.lit(2) + F.col("user_id") % 5).cast("short"))
    spectra = e.select(F.col("event_id").alias("scan"), F.array(F.struct(F.col("value").alias("mz"), z.alias("charge"))).alias("precursors"))
    return P.explode_precursors(spectra, 6).select("scan", F.col("precursor_mz").alias("mz"), F.col("charge").cast("long").alias("charge"))


_BOUNDS = f"SELECT *, mass_int - mass_int * {PPM} // 1000000 AS lo, mass_int + mass_int * {PPM} // 1000000 AS hi FROM ({V.PRECURSOR})"


def _bounded(spark: SparkSession, d: str) -> DataFrame:
    return P.with_bounds(V.precursor(spark, d), "mass_int", PPM, PPM)


@query(f"SELECT scan, mass_int, lo, hi FROM ({_BOUNDS})")
def ppm_bounds(spark: SparkSession, d: str) -> DataFrame:
    return _bounded(spark, d).select("scan", "mass_int", "lo", "hi")


# candidates

_PAIRS = f"SELECT p.scan, p.run, p.charge, p.mass_int, l.peptide_id, l.peptide, l.library_mass FROM ({_BOUNDS}) p JOIN ({V.LIBRARY}) l ON l.library_mass BETWEEN p.lo AND p.hi"


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return C.mass_window_join(_bounded(spark, d).select("scan", "run", "charge", "mass_int", "lo", "hi"), V.library(spark, d), WIDTH)


@query(f"SELECT scan, mass_int, peptide_id, library_mass FROM ({_PAIRS})")
def mass_window_join(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select("scan", "mass_int", "peptide_id", "library_mass")


@query(f"SELECT scan, count(*) AS candidates, min(library_mass) AS least, max(library_mass) AS most FROM ({_PAIRS}) GROUP BY scan")
def mass_window_counts(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).groupBy("scan").agg(F.count(F.lit(1)).alias("candidates"), F.min("library_mass").alias("least"), F.max("library_mass").alias("most"))


@query(f"SELECT scan, CAST(sum(strlen(peptide)) * 4 AS BIGINT) AS size, count(*) AS len FROM ({_PAIRS}) GROUP BY scan")
def candidate_size_metric(spark: SparkSession, d: str) -> DataFrame:
    return C.size_metric(_pairs(spark, d), ["scan"])


@query(f"SELECT charge, count(*) AS scans, CAST(sum(n) AS BIGINT) AS candidates FROM (SELECT scan, charge, count(*) AS n FROM ({_PAIRS}) GROUP BY ALL) WHERE n > 1 GROUP BY charge")
def charge_state_conflicts(spark: SparkSession, d: str) -> DataFrame:
    counts = _pairs(spark, d).groupBy("scan", "charge").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counts.groupBy("charge").agg(F.count(F.lit(1)).alias("scans"), F.sum("n").alias("candidates"))


#: Folders of the library by quantiles; exact ones where the sketch has room for all masses.
PARTITIONS = 8
_LIMITS = f"SELECT k, min(library_mass) AS mass_limit FROM (SELECT library_mass, row_number() OVER (ORDER BY library_mass) AS nr, count(*) OVER () AS n FROM ({V.LIBRARY})), range(1, {PARTITIONS}) t(k) WHERE nr * {PARTITIONS} >= k * n GROUP BY k"
_LAYOUT = f"""WITH limits AS (SELECT DISTINCT mass_limit FROM ({_LIMITS})), ordered AS (SELECT list(mass_limit ORDER BY mass_limit) AS l FROM limits),
  lib AS (SELECT len(list_filter(l, lambda x: x < library_mass)) AS p, library_mass FROM ({V.LIBRARY}), ordered),
  win AS (SELECT len(list_filter(l, lambda x: x < lo)) AS a, len(list_filter(l, lambda x: x < hi)) AS b FROM ({_BOUNDS}), ordered WHERE lo <= hi),
  met AS (SELECT p, count(*) AS windows FROM (SELECT unnest(range(a, b + 1)) AS p FROM win) GROUP BY p)
  SELECT CAST(lib.p AS BIGINT) AS partition, count(*) AS peptides, max(library_mass) AS most, max(coalesce(windows, 0)) AS windows FROM lib LEFT JOIN met USING (p) GROUP BY lib.p"""


@query(_LAYOUT)
def library_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Peptides of each folder by mass quantiles, and the windows that meet it."""
    library = V.library(spark, d)
    limits = layout.quantile_limits(library, PARTITIONS, "library_mass", 1_000_000)
    rows = library.groupBy(layout.partition_of(F.col("library_mass"), limits).alias("partition")).agg(F.count(F.lit(1)).alias("peptides"), F.max("library_mass").alias("most"))
    ends = [layout.partition_of(F.col(c), limits) for c in ("lo", "hi")]
    met = _bounded(spark, d).where("lo <= hi").select(F.explode(F.sequence(*ends)).alias("partition")).groupBy("partition").agg(F.count(F.lit(1)).alias("windows"))
    return rows.join(met, "partition", "left").withColumn("windows", F.coalesce("windows", F.lit(0)))


_DECOYS = f"SELECT sequence FROM ({V.PEPTIDES})"
_TARGETS = "SELECT DISTINCT upper(regexp_replace(p_name, '[^a-z]', '', 'g')) AS sequence FROM part UNION SELECT DISTINCT upper(w) FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark) WHERE regexp_matches(w, '^[A-Za-z]+$')"


def _targets(spark: SparkSession, d: str) -> DataFrame:
    known = V.library(spark, d).select(F.col("peptide").alias("sequence"))
    words = V.table(spark, d, "benchmark").select(F.explode(F.split("text", " ")).alias("w"))
    return known.unionByName(words.where(F.col("w").rlike("^[A-Za-z]+$")).select(F.upper("w").alias("sequence"))).distinct()


@query(f"SELECT sequence FROM ({_DECOYS}) ANTI JOIN ({_TARGETS}) USING (sequence)")
def decoy_target_antijoin(spark: SparkSession, d: str) -> DataFrame:
    return C.without_targets(V.peptides(spark, d), _targets(spark, d))


@query(f"SELECT sequence FROM ({_DECOYS}) SEMI JOIN ({_TARGETS}) USING (sequence)")
def target_semijoin(spark: SparkSession, d: str) -> DataFrame:
    return C.known_targets(V.peptides(spark, d), _targets(spark, d))


_PART_DECOYS = "SELECT s_suppkey AS scan, 'D' || CAST(s_suppkey AS VARCHAR) AS peptide FROM supplier"
_UNION = f"SELECT scan, peptide, true AS is_target FROM ({_PAIRS}) UNION ALL SELECT scan, peptide, false FROM ({_PART_DECOYS})"


def _union(spark: SparkSession, d: str) -> DataFrame:
    made = V.table(spark, d, "supplier").select(F.col("s_suppkey").alias("scan"), F.concat(F.lit("D"), F.col("s_suppkey").cast("string")).alias("peptide"))
    return C.union_candidates(_pairs(spark, d).select("scan", "peptide"), made)


@query(_UNION)
def union_targets_decoys(spark: SparkSession, d: str) -> DataFrame:
    return _union(spark, d)


@query(f"SELECT scan, count(*) FILTER (is_target) AS targets, count(*) FILTER (NOT is_target) AS decoys, 3 * count(*) FILTER (is_target) AS needed FROM ({_UNION}) GROUP BY scan")
def needed_decoys(spark: SparkSession, d: str) -> DataFrame:
    return C.needed_decoys(_union(spark, d), ["scan"], 3)


_CACHED = "SELECT l_orderkey AS scan, l_partkey AS decoy FROM lineitem WHERE l_returnflag = 'R'"
_MADE = "SELECT l_orderkey AS scan, l_partkey AS decoy FROM lineitem WHERE l_returnflag <> 'R'"


@query(
    f"SELECT scan, decoy, rank FROM (SELECT *, row_number() OVER (PARTITION BY scan ORDER BY rank, decoy) AS nr FROM (SELECT *, 0 AS rank FROM ({_CACHED}) UNION ALL SELECT *, 1 AS rank FROM ({_MADE})) "
    "JOIN (SELECT o_orderkey AS scan, o_custkey % 4 AS needed FROM orders) USING (scan)) WHERE nr <= needed"
)
def decoy_topup(spark: SparkSession, d: str) -> DataFrame:
    rows = V.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("scan"), F.col("l_partkey").alias("decoy"), "l_returnflag")
    needed = V.table(spark, d, "orders").select(F.col("o_orderkey").alias("scan"), (F.col("o_custkey") % 4).alias("needed"))
    cached, made = rows.where("l_returnflag = 'R'").drop("l_returnflag"), rows.where("l_returnflag <> 'R'").drop("l_returnflag")
    return C.top_up(cached, made, needed, ["scan"], ["decoy"]).select("scan", "decoy", "rank")


@query(f"SELECT scan, peptide_id FROM (SELECT *, row_number() OVER (PARTITION BY scan ORDER BY library_mass, peptide_id) AS nr FROM ({_PAIRS})) WHERE nr <= 5")
def candidate_limit(spark: SparkSession, d: str) -> DataFrame:
    scans = _bounded(spark, d).select("scan", "lo", "hi")
    return C.first_of_windows(scans, V.library(spark, d), WIDTH, ["scan"], ["peptide_id"], 5).select("scan", "peptide_id")


# false-discovery rates

_MARKED = f"SELECT *, protein NOT LIKE 'moy%' AS is_target FROM ({V.PSMS})"
_ORDER = "xcorr DESC NULLS LAST, " + ", ".join(V.PSM_TIES)


def _fdr_sql(by: str = "") -> str:
    w = f"({by} ORDER BY {_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"SELECT *, CAST(sum(CASE WHEN is_target THEN 0 ELSE 1 END) OVER {w} AS BIGINT) AS decoys, count(*) OVER {w} AS rank FROM ({_MARKED})"


def _marked(spark: SparkSession, d: str) -> DataFrame:
    return fdr.mark_targets(V.psms(spark, d))


@query(f"SELECT scan, line, protein, is_target FROM ({_MARKED})")
def mark_targets(spark: SparkSession, d: str) -> DataFrame:
    return _marked(spark, d).select("scan", "line", "protein", "is_target")


@query(f"SELECT scan, line, xcorr, rank, round(decoys / rank, 6) AS fdr FROM ({_fdr_sql()})")
def fdr_global(spark: SparkSession, d: str) -> DataFrame:
    return fdr.fdr_global(_marked(spark, d), "xcorr", V.PSM_TIES, written).select("scan", "line", "xcorr", "rank", F.round("fdr", 6).alias("fdr"))


@query(f"SELECT scan, line, run, rank, round(decoys / rank, 6) AS fdr FROM ({_fdr_sql('PARTITION BY run')})")
def fdr_per_run(spark: SparkSession, d: str) -> DataFrame:
    return fdr.fdr_ranged(_marked(spark, d), ["run"], "xcorr", V.PSM_TIES, written).select("scan", "line", "run", "rank", F.round("fdr", 6).alias("fdr"))


@query(f"SELECT scan, line, decoys FROM ({_fdr_sql()})")
def decoy_cumulative(spark: SparkSession, d: str) -> DataFrame:
    return fdr.fdr_global(_marked(spark, d), "xcorr", V.PSM_TIES, written).select("scan", "line", "decoys")


# features of matches


@query(f"SELECT scan, line, round(ions_matched / ions_total, 6) AS ions_matched_ratio, round(abs(experimental_mass - theoretical_mass), 8) AS mass_error FROM ({V.PSMS})")
def psm_features(spark: SparkSession, d: str) -> DataFrame:
    return FE.with_features(V.psms(spark, d)).select("scan", "line", F.round("ions_matched_ratio", 6).alias("ions_matched_ratio"), F.round("mass_error", 8).alias("mass_error"))


@query(
    f"SELECT scan, line, CAST(unnest([0, 1, 2]) AS INTEGER) AS feature, round(unnest([xcorr, ions_matched / ions_total, abs(experimental_mass - theoretical_mass)]), 8) AS value FROM ({V.PSMS})"
)
def feature_array(spark: SparkSession, d: str) -> DataFrame:
    """The feature vector of every match, one row a feature."""
    rows = FE.feature_array(FE.with_features(V.psms(spark, d)))
    return rows.select("scan", "line", F.posexplode("features").alias("feature", "value")).withColumn("value", F.round("value", 8))


@query(f"SELECT scan, line, xcorr FROM ({V.PSMS}) WHERE xcorr >= 50000")
def psm_threshold(spark: SparkSession, d: str) -> DataFrame:
    return FE.above_threshold(V.psms(spark, d), 50000).select("scan", "line", "xcorr")


@query(ORACLES["decoy_target_antijoin"])
def decoy_target_bloom(spark: SparkSession, d: str) -> DataFrame:
    targets = written(_targets(spark, d), "targets")
    return membership.without_known(V.peptides(spark, d), targets, membership.build_filter(targets))


@query(ORACLES["target_semijoin"])
def target_bloom(spark: SparkSession, d: str) -> DataFrame:
    targets = written(_targets(spark, d), "targets")
    return membership.only_known(V.peptides(spark, d), targets, membership.build_filter(targets))


@query(f"SELECT scan, line, xcorr FROM ({V.PSMS}) ORDER BY xcorr DESC, scan DESC, line DESC LIMIT 100")
def psm_sort_topk(spark: SparkSession, d: str) -> DataFrame:
    rows = V.psms(spark, d).withColumn("seq_no", F.struct("scan", "line"))
    return FE.best_first(rows, "seq_no").limit(100).select("scan", "line", "xcorr")


@query(f"SELECT scan, min(library_mass) AS least, nullif(max(library_mass), min(library_mass)) AS second FROM ({_PAIRS}) GROUP BY scan")
def second_theoretical_mass_null(spark: SparkSession, d: str) -> DataFrame:
    rows = _pairs(spark, d).groupBy("scan").agg(F.min("library_mass").alias("least"), F.max("library_mass").alias("most"))
    return rows.select("scan", "least", FE.second_mass(F.col("least"), F.col("most")).alias("second"))


# sequences


@query(f"SELECT doc_id, CAST(len(list_filter(range(1, length(sequence)), lambda i: sequence[i] IN ('K', 'R') AND sequence[i + 1] <> 'P')) AS BIGINT) AS missed FROM ({V.SEQUENCES})")
def missed_cleavages(spark: SparkSession, d: str) -> DataFrame:
    return V.sequences(spark, d).select("doc_id", sequence.missed_cleavages(F.col("sequence")).cast("long").alias("missed"))


_MASS = f"CAST({mass_int(WATER)} AS BIGINT) + " + " + ".join(f"(length(sequence) - length(replace(sequence, '{a}', ''))) * {mass_int(m)}" for a, m in RESIDUES.items())


@query(f"SELECT sequence, {_MASS} AS mass FROM ({V.PEPTIDES})")
def sequence_mass(spark: SparkSession, d: str) -> DataFrame:
    return V.peptides(spark, d).select("sequence", sequence.sequence_mass(F.col("sequence")).alias("mass"))


LIMITS = [500 * SCALE, 750 * SCALE, 1000 * SCALE, 1500 * SCALE]
_PART = " + ".join(f"CASE WHEN mass > {x} THEN 1 ELSE 0 END" for x in LIMITS)


@query(f"SELECT CAST({_PART} AS BIGINT) AS mass_partition, count(*) AS n, CAST(sum(mass) AS BIGINT) AS total FROM (SELECT {_MASS} AS mass FROM ({V.PEPTIDES})) GROUP BY 1")
def mass_partition(spark: SparkSession, d: str) -> DataFrame:
    rows = sequence_mass(spark, d).withColumn("mass_partition", sequence.mass_partition(F.col("mass"), LIMITS))
    return rows.groupBy("mass_partition").agg(F.count(F.lit(1)).alias("n"), F.sum("mass").alias("total"))


_RESIDUES = "SELECT * FROM (VALUES " + ", ".join(f"('{a}', CAST({mass_int(m)} AS BIGINT))" for a, m in RESIDUES.items()) + ") t(residue, total)"


#: The residues that occur in the peptides of the library.
_USED = f"SELECT * FROM ({_RESIDUES}) WHERE residue IN (SELECT DISTINCT unnest(string_split(peptide, '')) FROM ({V.LIBRARY}))"


def _used(spark: SparkSession, d: str) -> DataFrame:
    letters = V.library(spark, d).select(F.explode(F.split("peptide", "")).alias("residue")).distinct()
    return ptm.residue_table(spark).join(letters, "residue", "left_semi")


@query(f"SELECT a.residue AS from_residue, b.residue AS to_residue, b.total - a.total AS distance FROM ({_USED}) a, ({_USED}) b")
def residue_mass_matrix(spark: SparkSession, d: str) -> DataFrame:
    return ptm.distance_matrix(_used(spark, d).withColumnRenamed("mass", "total"))


_NEED = f"SELECT event_id, CAST(round(value * {SCALE}) AS BIGINT) AS need FROM events"


@query(f"SELECT event_id, need, residue, distance FROM (SELECT event_id, need, residue, abs(total - need) AS distance, row_number() OVER (PARTITION BY event_id ORDER BY abs(total - need), residue) AS nr FROM ({_NEED}), ({_RESIDUES})) WHERE nr = 1")
def nearest_residue(spark: SparkSession, d: str) -> DataFrame:
    rows = V.table(spark, d, "events").select("event_id", P.mass_int(F.col("value")).alias("need"))
    return ptm.nearest_residue(rows, ptm.residue_table(spark).withColumnRenamed("mass", "total"))


#: Modifications of the examples.
PTMS = [("C", 57.021464, "Static", "Anywhere"), ("M", 15.994915, "Variable", "Anywhere"), ("K", 42.010565, "Static", "Terminus_N")]
_PTMS = "SELECT * FROM (VALUES " + ", ".join(f"('{a}', CAST({m} AS DOUBLE), '{t}', '{p}')" for a, m, t, p in PTMS) + ") t(amino_acid, mass_delta, mod_type, position)"
_ALPHABET = (
    f"SELECT residue, total AS mass, CAST(0 AS BIGINT) AS delta, total FROM ({_USED}) WHERE residue NOT IN (SELECT amino_acid FROM ({_PTMS}) WHERE mod_type = 'Static') "
    f"UNION ALL SELECT residue, total, CAST(round(mass_delta * {SCALE}) AS BIGINT), total + CAST(round(mass_delta * {SCALE}) AS BIGINT) FROM ({_USED}) JOIN ({_PTMS}) ON residue = amino_acid WHERE mod_type = 'Static' AND position = 'Anywhere'"
)


def _alphabet(spark: SparkSession, d: str) -> DataFrame:
    return ptm.alphabet(_used(spark, d), spark.createDataFrame(PTMS, ptm.PTM_SCHEMA))


@query(_ALPHABET)
def static_alphabet(spark: SparkSession, d: str) -> DataFrame:
    return _alphabet(spark, d)


@query(f"SELECT residue, total FROM ({_ALPHABET}) WHERE residue IN ('K', 'R')")
def cleavage_parts(spark: SparkSession, d: str) -> DataFrame:
    return ptm.cleavage_parts(_alphabet(spark, d)).select("residue", "total")


# names


def _fasta_sql(seq: str) -> str:
    return f"regexp_replace({seq}, '(.{{60}})', '\\1' || chr(10), 'g')"


@query(
    f"SELECT doc_id, '>moy|D' || CAST(doc_id AS VARCHAR) || '|D' || CAST(doc_id AS VARCHAR) || chr(10) || CASE WHEN length(sequence) % 60 = 0 AND length(sequence) > 0 THEN left({_fasta_sql('sequence')}, length({_fasta_sql('sequence')}) - 1) ELSE {_fasta_sql('sequence')} END || chr(10) AS entry FROM ({V.SEQUENCES})"
)
def fasta_entry(spark: SparkSession, d: str) -> DataFrame:
    return V.sequences(spark, d).select("doc_id", naming.fasta_entry(F.col("sequence"), F.col("doc_id"), False).alias("entry"))


@query("SELECT page_id, regexp_replace(url, '[^\\p{L}\\p{N}_]', '_', 'g') AS word FROM pages")
def sanitize_word(spark: SparkSession, d: str) -> DataFrame:
    return V.table(spark, d, "pages").select("page_id", naming.sanitize_word(F.col("url")).alias("word"))


@query("SELECT page_id, regexp_replace(regexp_replace(html, '^\\s+|\\s+$', '', 'g'), '[\\s/\\x00]+', '_', 'g') AS name FROM pages")
def sanitize_path(spark: SparkSession, d: str) -> DataFrame:
    return V.table(spark, d, "pages").select("page_id", naming.sanitize_path(F.col("html")).alias("name"))


_PATH = "SELECT event_id, event_type || '/' || CAST(user_id AS VARCHAR) || '/' || regexp_replace(regexp_replace(props, '^\\s+|\\s+$', '', 'g'), '[\\s/\\x00]+', '_', 'g') || '/' || CAST(value AS VARCHAR) || '_' || CAST(2 + user_id % 5 AS VARCHAR) || '.psms.parquet' AS path FROM events"


def _paths(spark: SparkSession, d: str) -> DataFrame:
    e = V.table(spark, d, "events")
    return e.select("event_id", naming.precursor_path(F.col("event_type"), F.col("user_id"), F.col("props"), F.col("value"), F.lit(2) + F.col("user_id") % 5, "psms.parquet").alias("path"))


@query(_PATH)
def precursor_path(spark: SparkSession, d: str) -> DataFrame:
    return _paths(spark, d)


@query("SELECT event_id, value AS mz, CAST(2 + user_id % 5 AS INTEGER) AS charge FROM events")
def parse_precursor_path(spark: SparkSession, d: str) -> DataFrame:
    mz, charge = naming.parse_precursor(F.col("path"))
    return _paths(spark, d).select("event_id", mz.alias("mz"), charge.alias("charge"))


# spectra and scores

_BIN = f"CAST(floor(mz / {BINS.bin_size} + 1 - {BINS.bin_offset}) AS BIGINT)"
_BINNED = f"SELECT scan, {_BIN} AS bin, max(sqrt(intensity)) AS height FROM ({V.PEAKS}) WHERE intensity >= {BINS.minimum_intensity} GROUP BY ALL"
_PARTS = f"SELECT *, CAST(floor(bin * {BINS.windows} / (max(bin) OVER (PARTITION BY scan) + 1)) AS BIGINT) AS part FROM ({_BINNED})"
_HEIGHTS = f"SELECT scan, bin, CASE WHEN max(height) OVER p > 0 THEN height * 50 / max(height) OVER p ELSE 0.0 END AS y FROM ({_PARTS}) WINDOW p AS (PARTITION BY scan, part)"


def _heights(spark: SparkSession, d: str) -> DataFrame:
    return xcorr.normalised(xcorr.binned(V.peaks(spark, d), BINS), BINS)


@query(f"SELECT scan, bin, round(height, 6) AS height FROM ({_BINNED})")
def peak_binning(spark: SparkSession, d: str) -> DataFrame:
    return xcorr.binned(V.peaks(spark, d), BINS).select("scan", "bin", F.round("height", 6).alias("height"))


@query(f"SELECT scan, bin, round(y, 6) AS y FROM ({_HEIGHTS})")
def peak_window_normalise(spark: SparkSession, d: str) -> DataFrame:
    return _heights(spark, d).select("scan", "bin", F.round("y", 6).alias("y"))


def _ions_sql(source: str, key: str, mods: ptm.StaticModifications = ptm.UNMODIFIED) -> str:
    masses = "MAP {" + ", ".join(f"'{a}': {mass_int(m) + mods.delta(a)}" for a, m in RESIDUES.items()) + "}"
    rows = f"SELECT {key}, place, {masses}[sequence[place]] AS m, length(sequence) AS n FROM (SELECT {key}, sequence, unnest(range(1, length(sequence) + 1)) AS place FROM ({source}))"
    return (
        f"SELECT {key}, place, n, CAST(sum(coalesce(m, 0)) OVER (PARTITION BY {key} ORDER BY place) AS BIGINT) AS prefix, CAST(sum(coalesce(m, 0)) OVER (PARTITION BY {key}) AS BIGINT) AS whole FROM ({rows})"
    )


_PEP_IONS = _ions_sql(V.PEPTIDES.replace("AS sequence", "AS sequence, upper(w) AS key"), "key")


@query(f"SELECT key AS sequence, CAST(place AS BIGINT) AS number, round(prefix / {SCALE} + {PROTON}, 5) AS mz FROM ({_PEP_IONS}) WHERE place < n")
def fragment_ions_b(spark: SparkSession, d: str) -> DataFrame:
    rows = V.peptides(spark, d).withColumn("key", F.col("sequence"))
    return fragments.ions(rows, "key", ("B",), 1).select(F.col("key").alias("sequence"), "number", F.round("mz", 5).alias("mz"))


@query(f"SELECT key AS sequence, CAST(n - place AS BIGINT) AS number, round((whole - prefix + {mass_int(WATER)}) / {SCALE} + {PROTON}, 5) AS mz FROM ({_PEP_IONS}) WHERE place < n")
def fragment_ions_y(spark: SparkSession, d: str) -> DataFrame:
    rows = V.peptides(spark, d).withColumn("key", F.col("sequence"))
    return fragments.ions(rows, "key", ("Y",), 1).select(F.col("key").alias("sequence"), "number", F.round("mz", 5).alias("mz"))


_LOSS = " UNION ALL ".join(
    f"SELECT key AS sequence, '{kind}-{name}' AS kind, CAST({number} AS BIGINT) AS number, round({mass} / {SCALE} + {PROTON} - {loss / SCALE}, 5) AS mz FROM ({_PEP_IONS}) WHERE place < n AND regexp_matches({part}, '[{residues}]')"
    for name, loss, residues in fragments.LOSSES
    for kind, number, mass, part in (("B", "place", "prefix", "substr(key, 1, place)"), ("Y", "n - place", f"(whole - prefix + {mass_int(WATER)})", "substr(key, place + 1)"))
)


@query(_LOSS)
def neutral_loss_ions(spark: SparkSession, d: str) -> DataFrame:
    rows = V.peptides(spark, d).withColumn("key", F.col("sequence"))
    return fragments.loss_ions(rows, "key").select(F.col("key").alias("sequence"), "kind", "number", F.round("mz", 5).alias("mz"))


# a run's candidates are those of its precursors; the part's name is the peptide
_RUN_PEPTIDES = f"SELECT DISTINCT run AS scan, peptide FROM ({_PAIRS})"
_LIB_IONS = _ions_sql(f"SELECT DISTINCT peptide AS key, peptide AS sequence FROM ({V.LIBRARY})", "key")
_LIB_BINS = (
    f"SELECT key AS peptide, CAST(floor((prefix / {SCALE} + {PROTON}) / {BINS.bin_size} + 1) AS BIGINT) AS bin FROM ({_LIB_IONS}) WHERE place < n "
    f"UNION ALL SELECT key, CAST(floor(((whole - prefix + {mass_int(WATER)}) / {SCALE} + {PROTON}) / {BINS.bin_size} + 1) AS BIGINT) FROM ({_LIB_IONS}) WHERE place < n"
)
_WANTED = f"SELECT scan, peptide, bin FROM ({_RUN_PEPTIDES}) JOIN ({_LIB_BINS}) USING (peptide)"
_POINTS = f"SELECT scan, bin, max(y) AS y FROM (SELECT * FROM ({_HEIGHTS}) UNION ALL SELECT scan, unnest([bin - 1, bin, bin + 1]), 0.0 FROM ({_WANTED})) GROUP BY ALL"
_FAST = f"SELECT *, y - (sum(y) OVER (PARTITION BY scan ORDER BY bin RANGE BETWEEN {BINS.background} PRECEDING AND {BINS.background} FOLLOWING) - y) / {2 * BINS.background} AS fast FROM ({_POINTS})"
_FLANKED = f"SELECT scan, bin, y, fast + 0.5 * (sum(fast) OVER (PARTITION BY scan ORDER BY bin RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) - fast) AS fast FROM ({_FAST})"


def _wanted(spark: SparkSession, d: str) -> DataFrame:
    library = V.library(spark, d).select("peptide", "library_mass").distinct()
    runs = C.with_ends(_bounded(spark, d).select(F.col("run").alias("scan"), "lo", "hi"), library, WIDTH).select("scan", "least", "most").distinct()
    pairs = runs.join(C.spaces(runs, library, WIDTH).select("least", "most", "peptide").distinct(), ["least", "most"]).select("scan", "peptide").distinct()
    peptides = V.library(spark, d).select(F.col("peptide").alias("key"), F.col("peptide").alias("sequence")).distinct()
    ions = fragments.ions(peptides, "key", BINS.ions, 1).select(F.col("key").alias("peptide"), xcorr.bin_of(F.col("mz"), BINS).alias("bin"))
    return pairs.join(ions, "peptide").select("scan", "peptide", "bin")


@query(f"SELECT scan, bin, round(y, 6) AS y, round(fast, 6) AS fast FROM ({_FAST.replace('[bin - 1, bin, bin + 1]', '[bin]')})")
def xcorr_background(spark: SparkSession, d: str) -> DataFrame:
    return xcorr.corrected(_heights(spark, d), _wanted(spark, d).select("scan", "bin").distinct(), BINS).select("scan", "bin", F.round("y", 6).alias("y"), F.round("fast", 6).alias("fast"))


_XCORR = f"SELECT scan, peptide, round(sum(fast) * 0.005, 6) AS xcorr, count(*) AS ions_total, count(*) FILTER (y > 0) AS ions_matched FROM ({_WANTED}) JOIN ({_FLANKED}) USING (scan, bin) GROUP BY scan, peptide"


@query(_XCORR)
def xcorr_score(spark: SparkSession, d: str) -> DataFrame:
    wanted = written(_wanted(spark, d), "ions")
    return xcorr.scores(_heights(spark, d), wanted, BINS, tasks=xcorr.tasks_for(wanted)).select("scan", "peptide", F.round("xcorr", 6).alias("xcorr"), "ions_total", "ions_matched")


@query(_XCORR)
def scan_score(spark: SparkSession, d: str) -> DataFrame:
    """The scores of ``xcorr_score`` as the search computes them, from one row a spectrum."""
    spectra = V.peaks(spark, d).where("mz is not null and intensity is not null").groupBy("scan").agg(F.collect_list("mz").alias("mz"), F.collect_list("intensity").alias("intensity"))
    none = {c: F.lit(None) for c in ("uuid", "ms_run", "spectrum_id", "precursor_no", "precursor_mz", "precursor_da")}
    pairs = _pairs(spark, d).select(F.col("run").alias("scan"), "peptide").distinct().withColumns({"is_target": F.lit(True), "library_mass": F.lit(0)})
    spectra = pairs.select("scan").distinct().join(spectra, "scan", "left")  # a run without peaks has scores as well
    got = scan_scores.scored(spectra.withColumns({**none, "spectrum_id": F.col("scan").cast("string"), "charge": F.lit(2)}), pairs, BINS)
    return got.select(F.col("spectrum_id").cast("long").alias("scan"), "peptide", F.round("xcorr", 6).alias("xcorr"), "ions_total", "ions_matched")


# outlier probabilities

K = 10
_NEAR = (
    f"SELECT * FROM (SELECT a.grp, a.vec_id, b.vec_id AS near, (a.f0 - b.f0) ** 2 + (a.f1 - b.f1) ** 2 + (a.f2 - b.f2) ** 2 AS d2, row_number() OVER (PARTITION BY a.vec_id ORDER BY (a.f0 - b.f0) ** 2 + (a.f1 - b.f1) ** 2 + (a.f2 - b.f2) ** 2, b.vec_id) AS nr "
    f"FROM ({V.FEATURES}) a JOIN ({V.FEATURES}) b ON a.grp = b.grp AND a.vec_id <> b.vec_id) WHERE nr <= {K}"
)
_PDIST = f"SELECT grp, vec_id, 3 * sqrt(avg(d2)) AS pdist FROM ({_NEAR}) GROUP BY ALL"
_PLOF = f"SELECT n.grp, n.vec_id, p.pdist / avg(q.pdist) - 1 AS plof FROM ({_NEAR}) n JOIN ({_PDIST}) p ON n.vec_id = p.vec_id JOIN ({_PDIST}) q ON n.near = q.vec_id GROUP BY n.grp, n.vec_id, p.pdist"


def _loop(spark: SparkSession, d: str) -> DataFrame:
    return loop.with_loop(V.features(spark, d), ["grp"], ["f0", "f1", "f2"], ["vec_id"], k=K)


@query(f"SELECT vec_id, round(pdist, 6) AS pdist FROM ({_PDIST})")
def knn(spark: SparkSession, d: str) -> DataFrame:
    return loop.with_pdist(V.features(spark, d), ["grp"], ["f0", "f1", "f2"], ["vec_id"], k=K).select("vec_id", F.round("pdist", 6).alias("pdist"))


@query(f"SELECT vec_id, round(plof, 6) AS plof, round(3 * sqrt(avg(plof * plof) OVER (PARTITION BY grp)), 6) AS nplof FROM ({_PLOF})")
def loop_plof(spark: SparkSession, d: str) -> DataFrame:
    return _loop(spark, d).select("vec_id", F.round("plof", 6).alias("plof"), F.round("nplof", 6).alias("nplof"))


# the error function by its series of positive terms
_X = f"greatest(plof, 0.0) / (3 * sqrt(avg(plof * plof) OVER (PARTITION BY grp)) * {2**0.5})"
_ERF = f"CASE WHEN x >= 6 THEN 1.0 ELSE {2 / 3.141592653589793**0.5} * exp(-x * x) * list_sum(list_transform(range(0, 151), lambda i: x * list_product(list_transform(range(0, i), lambda j: 2 * x * x / (2 * j + 3)) || [1.0]))) END"


@query(f"SELECT vec_id, round({_ERF}, 6) AS loop_score FROM (SELECT vec_id, {_X} AS x FROM ({_PLOF}))")
def loop_score(spark: SparkSession, d: str) -> DataFrame:
    return _loop(spark, d).select("vec_id", F.round("loop_score", 6).alias("loop_score"))


# static modifications in masses, ions and decoys

MODS = ptm.StaticModifications((("C", 57_021_464), ("M", 15_994_915)), 42_010_565, -984_016)
_MODIFIED = f"({_MASS}) + {MODS.n_bond + MODS.c_bond} + " + " + ".join(f"(length(sequence) - length(replace(sequence, '{a}', ''))) * {m}" for a, m in MODS.residues)
_MODIFIED_IONS = _ions_sql(V.PEPTIDES.replace("AS sequence", "AS sequence, upper(w) AS key"), "key", MODS)


@query(f"SELECT sequence, {_MODIFIED} AS mass FROM ({V.PEPTIDES})")
def modified_mass(spark: SparkSession, d: str) -> DataFrame:
    return V.peptides(spark, d).select("sequence", sequence.sequence_mass(F.col("sequence"), MODS).alias("mass"))


@query(
    f"SELECT key AS sequence, 'B' AS kind, CAST(place AS BIGINT) AS number, round((prefix + {MODS.n_bond}) / {SCALE} + {PROTON}, 5) AS mz FROM ({_MODIFIED_IONS}) WHERE place < n "
    f"UNION ALL SELECT key, 'Y', CAST(n - place AS BIGINT), round((whole - prefix + {mass_int(WATER) + MODS.c_bond}) / {SCALE} + {PROTON}, 5) FROM ({_MODIFIED_IONS}) WHERE place < n"
)
def modified_ions(spark: SparkSession, d: str) -> DataFrame:
    rows = V.peptides(spark, d).withColumn("key", F.col("sequence"))
    return fragments.ions(rows, "key", mods=MODS).select(F.col("key").alias("sequence"), "kind", "number", F.round("mz", 5).alias("mz"))


@query(f"SELECT sequence, replace(replace(sequence, 'C', 'C[s57021464]'), 'M', 'M[s15994915]') AS annotated FROM ({V.PEPTIDES})")
def annotated_sequence(spark: SparkSession, d: str) -> DataFrame:
    return V.peptides(spark, d).select("sequence", sequence.annotated(F.col("sequence"), MODS).alias("annotated"))


# variable modifications: up to two of them on a peptide

VARIABLE = (variable.VariableModification("M", 15_994_915), variable.VariableModification("S", 79_966_331), variable.VariableModification("T", 79_966_331, "Terminus_N"), variable.VariableModification("", 42_010_565, "Bond_N"), variable.VariableModification("", -984_016, "Bond_C"))
MOST = 2
# places of each kind: residues from 1, the bonds 0 and one behind the last residue
_SITES = (
    "SELECT sequence, place, CASE sequence[place] WHEN 'M' THEN 15994915 ELSE 79966331 END AS delta FROM (SELECT sequence, unnest(range(1, length(sequence) + 1)) AS place FROM ({source})) "
    "WHERE sequence[place] IN ('M', 'S') OR place = 1 AND sequence[1] = 'T' UNION ALL SELECT sequence, 0, 42010565 FROM ({source}) UNION ALL SELECT sequence, length(sequence) + 1, -984016 FROM ({source})"
)


def _forms_sql(source: str) -> str:
    """sequence, form and delta of every form; the marks are cut in from the right, so that places keep their meaning."""
    mark = "'[v' || CAST({d} AS VARCHAR) || ']'"

    def cut(seq: str, place: str, d: str) -> str:
        m = mark.format(d=d)
        return f"CASE WHEN {place} = 0 THEN {m} || '-' || {seq} WHEN {place} > length(sequence) THEN {seq} || '-' || {m} ELSE substr({seq}, 1, {place}) || {m} || substr({seq}, {place} + 1) END"

    sites = f"({_SITES.format(source=source)})"
    return (
        f"SELECT sequence, sequence AS form, 0 AS delta FROM ({source}) UNION ALL SELECT sequence, {cut('sequence', 'place', 'delta')}, delta FROM {sites} "
        f"UNION ALL SELECT sequence, {cut('part', 'p1', 'd1')}, d1 + d2 FROM (SELECT a.sequence, a.place AS p1, a.delta AS d1, b.delta AS d2, {cut('a.sequence', 'b.place', 'b.delta').replace('length(sequence)', 'length(a.sequence)')} AS part FROM {sites} a JOIN {sites} b ON a.sequence = b.sequence AND a.place < b.place)"
    )


def _forms(peptides: DataFrame) -> DataFrame:
    """Every form of every peptide, with its delta: the whole mass axis is the window."""
    top = F.lit(1 << 62)
    rows = variable.shifted_windows(peptides.withColumns({"mass_int": top, "lo": top, "hi": top}), VARIABLE, MOST)
    return variable.forms(rows, "sequence", VARIABLE, MOST).select("sequence", "form", "delta")


@query(f"SELECT form, {_MASS.replace('sequence', 'f.sequence')} + delta AS mass FROM ({_forms_sql(V.PEPTIDES)}) f")
def variable_forms(spark: SparkSession, d: str) -> DataFrame:
    """All peptides with up to two variable modifications, and their masses."""
    return _forms(V.peptides(spark, d)).select("form", (sequence.sequence_mass(F.col("sequence")) + F.col("delta")).alias("mass"))


# b ions weigh the marks up to their residue and the front bond's, y ions the rest
_FORM_IONS = _ions_sql(f"SELECT DISTINCT peptide AS key, peptide AS sequence FROM ({V.LIBRARY})", "key")
_ONE_MARK = _SITES.format(source=f"SELECT DISTINCT peptide AS sequence FROM ({V.LIBRARY})")


@query(
    f"SELECT key AS sequence, s.place AS site, s.delta AS delta, kind, number, round(CASE kind WHEN 'B' THEN (prefix + CASE WHEN s.place <= i.place THEN s.delta ELSE 0 END) ELSE (whole - prefix + {mass_int(WATER)} + CASE WHEN s.place > i.place THEN s.delta ELSE 0 END) END / {SCALE} + {PROTON}, 5) AS mz "
    f"FROM (SELECT *, unnest(['B', 'Y']) AS kind, unnest([place, n - place]) AS number FROM ({_FORM_IONS}) WHERE place < n) i JOIN ({_ONE_MARK}) s ON s.sequence = key"
)
def variable_ions(spark: SparkSession, d: str) -> DataFrame:
    """Ions of every library peptide with one modification, by its site."""
    rows = _forms(V.library(spark, d).select(F.col("peptide").alias("sequence")).distinct()).where("form <> sequence")
    tokens = variable.tokens(F.col("form"))
    site = F.when(F.col("form").startswith("["), 0).when(F.col("form").endswith("]") & F.contains(F.element_at(tokens, -1), F.lit("-[")), F.size(tokens) + 1).otherwise(F.array_position(F.transform(tokens, lambda t: F.contains(t, F.lit("["))), True))
    rows = rows.where(F.regexp_count("form", F.lit("\\[")) == 1).withColumns({"site": site.cast("long"), "key": F.struct("sequence", site.cast("long").alias("site"), "delta")})
    return fragments.ions(rows, "key", sequence="form", marked=True).select("key.*", "kind", "number", F.round("mz", 5).alias("mz"))


@query(
    f"WITH forms AS (SELECT peptide_id, form, library_mass + delta AS mass FROM ({V.LIBRARY}) l JOIN ({_forms_sql(f'SELECT DISTINCT peptide AS sequence FROM ({V.LIBRARY})')}) f ON l.peptide = f.sequence) "
    f"SELECT p.scan, count(*) AS forms, min(f.mass) AS least, max(f.mass) AS most, min(form) AS first_form FROM ({_BOUNDS}) p JOIN forms f ON f.mass BETWEEN lo AND hi GROUP BY p.scan"
)
def variable_window_counts(spark: SparkSession, d: str) -> DataFrame:
    """Forms of library peptides in every precursor's window, counted by mass first; equal windows are looked up once."""
    peptides = V.library(spark, d).groupBy("peptide", "library_mass").agg(F.count(F.lit(1)).alias("n"))
    kinds = _forms(peptides.select(F.col("peptide").alias("sequence")).distinct()).groupBy(F.col("sequence").alias("peptide"), "delta").agg(F.count(F.lit(1)).alias("kinds"), F.min("form").alias("first_form"))
    by_mass = peptides.join(kinds, "peptide").groupBy((F.col("library_mass") + F.col("delta")).alias("mass")).agg(F.sum(F.col("n") * F.col("kinds")).alias("forms"), F.min("first_form").alias("first_form"))
    scans = _bounded(spark, d).select("scan", "lo", "hi")
    met = C.mass_window_join(scans.where("lo <= hi").select("lo", "hi").distinct(), by_mass, WIDTH, "mass")
    totals = lambda least, most: (F.sum("forms").alias("forms"), F.min(least).alias("least"), F.max(most).alias("most"), F.min("first_form").alias("first_form"))
    return scans.join(met.groupBy("lo", "hi").agg(*totals("mass", "mass")), ["lo", "hi"]).groupBy("scan").agg(*totals("least", "most"))


@query(f"SELECT peptide_id AS scan, n AS targets, n AS decoys, 0 AS missing FROM (SELECT a.peptide_id, count(*) AS n FROM ({V.LIBRARY}) a JOIN ({V.LIBRARY}) b ON b.library_mass BETWEEN a.library_mass - a.library_mass * {PPM} // 1000000 AND a.library_mass + a.library_mass * {PPM} // 1000000 GROUP BY a.peptide_id)")
def decoy_fillup(spark: SparkSession, d: str) -> DataFrame:
    """A search space around every library mass, with as many decoys as targets; none may be missing.  Peptides of one mass share theirs."""
    rows = P.with_bounds(V.library(spark, d).select(F.col("library_mass").alias("scan"), F.col("library_mass").alias("mass_int")).distinct(), "mass_int", PPM, PPM)
    library = V.library(spark, d).select(F.col("peptide").alias("sequence"), F.col("library_mass").alias("mass"))
    p = SearchParams(lower_mass_tolerance_ppm=PPM, upper_mass_tolerance_ppm=PPM, decoys_per_peptide=1)
    space = search_space(rows, library, p, MAX_MASS)
    missing = space.short.groupBy("scan").agg(F.sum("missing").alias("missing"))
    counts = space.candidates.groupBy("scan").agg(F.count_if("is_target").alias("targets"), F.count_if(~F.col("is_target")).alias("decoys"))
    counts = counts.join(missing, "scan", "left").withColumn("missing", F.coalesce("missing", F.lit(0))).withColumnRenamed("scan", "library_mass")
    peptides = V.library(spark, d).select(F.col("peptide_id").alias("scan"), "library_mass").join(counts, "library_mass")
    return peptides.groupBy("scan").agg(*(F.sum(c).cast(kind).alias(c) for c, kind in (("targets", "long"), ("decoys", "long"), ("missing", "int"))))


# progress, metrics, errors


@query("SELECT event_type || '_' || CAST(user_id AS VARCHAR) AS counter, count(*) AS n FROM events GROUP BY 1")
def event_counters(spark: SparkSession, d: str) -> DataFrame:
    return runner.event_counters(V.table(spark, d, "events"), "event_type", "user_id")


@query("SELECT event_id, 'controllerType=0 scan=' || CAST(event_id AS VARCHAR) || '+' AS spectrum_id FROM events")
def url_decoded_ids(spark: SparkSession, d: str) -> DataFrame:
    escaped = F.concat(F.lit("controllerType%3D0%20scan%3D"), F.col("event_id").cast("string"), F.lit("+"))
    return V.table(spark, d, "events").select("event_id", naming.url_decoded(escaped).alias("spectrum_id"))


def _spectra(spark: SparkSession, d: str) -> DataFrame:
    return V.table(spark, d, "lineitem").select((F.col("l_suppkey") % 10).alias("uuid"), F.col("l_linenumber").alias("ms_run"), F.col("l_orderkey").alias("spectrum_id"), (F.col("l_linestatus") == "F").alias("done"))


_SPECTRA = "SELECT l_suppkey % 10 AS uuid, l_linenumber AS ms_run, l_orderkey AS spectrum_id, l_linestatus = 'F' AS done FROM lineitem"


@query(
    f"SELECT uuid, total, finished, uuid % 2 = 0 AS enqueued, uuid % 2 = 0 AND total = finished AS is_finished FROM (SELECT uuid, count(DISTINCT (ms_run, spectrum_id)) AS total, count(DISTINCT (ms_run, spectrum_id)) FILTER (done) AS finished FROM ({_SPECTRA}) GROUP BY uuid)"
)
def search_progress(spark: SparkSession, d: str) -> DataFrame:
    s = _spectra(spark, d)
    flags = s.select("uuid", (F.col("uuid") % 2 == 0).alias("is_search_fully_enqueued"))
    return runner.progress(s, s.where("done"), flags)


@query(f"SELECT uuid, ms_run, count(DISTINCT spectrum_id) AS spectra FROM ({_SPECTRA}) GROUP BY ALL", "run_listing")
def _run_listing(spark: SparkSession, d: str) -> DataFrame:
    return run_listing(_spectra(spark, d))


@query(f"SELECT scan, unnest(['size', 'len']) AS metric, unnest([CAST(sum(strlen(peptide)) * 4 AS DOUBLE), CAST(count(*) AS DOUBLE)]) AS value FROM ({_PAIRS}) GROUP BY scan")
def metrics_long(spark: SparkSession, d: str) -> DataFrame:
    return sinks.metrics_long(C.size_metric(_pairs(spark, d), ["scan"]), ["scan"], {"size": F.col("size"), "len": F.col("len")})


@query("SELECT CASE WHEN o_orderpriority LIKE '1%' THEN 'precursor' WHEN o_orderpriority LIKE '2%' THEN 'spectrum' WHEN o_orderpriority LIKE '3%' THEN 'run' ELSE 'search' END AS level, count(*) AS n FROM orders GROUP BY 1")
def error_levels(spark: SparkSession, d: str) -> DataFrame:
    o = V.table(spark, d, "orders")
    first = F.substring("o_orderpriority", 1, 1)
    given = lambda *digits: F.when(first.isin(*digits), F.col("o_orderkey"))
    level = sinks.error_level(F.col("o_custkey"), given("1", "2", "3"), given("1", "2"), given("1"))
    return o.select(level.alias("level")).groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@query()
def decoy_udtf(spark: SparkSession, d: str) -> DataFrame:
    """Three decoys for every library mass."""
    rows = P.with_bounds(V.library(spark, d).select("peptide_id", F.col("library_mass").alias("mass_int")), "mass_int", PPM, PPM)
    made = decoys.generate(rows, "peptide_id", 3)
    return made.join(rows, "peptide_id").select("peptide_id", "nr", "sequence", "mass_int", sequence.sequence_mass(F.col("sequence")).alias("mass"))


@query("SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL")
def stream_equals_batch(spark: SparkSession, d: str) -> DataFrame:
    schema = V.table(spark, d, "events").schema
    return runner.counts_by_stream(spark, d, "events.parquet", schema, ["event_type", "user_id"], "stream")


@query(f"SELECT scan, peptide_id, is_target, nr, entry FROM (SELECT scan, peptide_id, true AS is_target, nr, '>mdb|T' || CAST(nr AS VARCHAR) || '|T' || CAST(nr AS VARCHAR) || chr(10) || peptide || chr(10) AS entry FROM (SELECT *, row_number() OVER (PARTITION BY scan ORDER BY peptide_id) AS nr FROM ({_PAIRS})))")
def search_space_fasta(spark: SparkSession, d: str) -> DataFrame:
    """Entries are numbered once for each pair of window ends; only the output has a row for each scan and peptide.

    It grows with the product of both, so its order decides what it takes on disk: an entry comes with many scans at once, whose rows Parquet stores as runs.
    """
    ends, block = ["least", "most"], ["least", "most", "n", "bucket", "part"]
    scans = C.with_ends(_bounded(spark, d).select("scan", "lo", "hi"), V.library(spark, d), WIDTH).groupBy("scan", *ends).agg(F.count(F.lit(1)).alias("n"))
    scans = written(scans.withColumn("windows", F.count(F.lit(1)).over(Window.partitionBy("scan"))), "scans")
    by_peptide = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy("peptide_id"))
    entry = naming.fasta_entry(F.col("peptide"), F.col("nr"), True)
    numbered = written(C.spaces(scans, V.library(spark, d), WIDTH).select(*ends, "peptide_id", "peptide", by_peptide(*ends).alias("nr")), "entries")
    # blocks of some scans and some entries of one space; the inputs are small beside the output, so its rows decide over the tasks
    once = scans.where("windows = 1").drop("windows")
    sizes = once.groupBy(*ends, "n").agg(F.count(F.lit(1)).alias("scans")).join(numbered.groupBy(*ends).agg(F.count(F.lit(1)).alias("entries")), ends)
    sizes = sizes.withColumn("buckets", F.ceil(F.col("scans") / SCANS_A_BLOCK)).withColumn("each", F.greatest(F.lit(1), F.floor(F.lit(ROWS_A_TASK // 2) / F.least("scans", F.lit(SCANS_A_BLOCK)))))
    total = sizes.agg(F.sum(F.col("scans") * F.col("entries") * F.col("n"))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // ROWS_A_TASK))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    parts = F.ceil(F.col("entries") * F.col("n") / F.col("each"))
    lists = once.join(sizes.select(*ends, "n", "buckets", parts.alias("parts")), [*ends, "n"]).withColumn("bucket", F.pmod(F.xxhash64("scan"), "buckets"))
    lists = lists.groupBy(*ends, "n", "bucket", "parts").agg(F.sort_array(F.collect_list(F.struct("scan"))).alias("scans")).withColumn("part", upto(F.col("parts")))
    # a scan with n equal windows has every peptide n times
    entries = numbered.join(sizes.select(*ends, "n", "buckets", "each"), ends).withColumn("copy", upto(F.col("n"))).withColumn("nr", ((F.col("nr") - 1) * F.col("n") + F.col("copy") + 1).cast("int"))
    entries = entries.withColumn("part", F.floor((F.col("nr") - 1) / F.col("each"))).withColumn("bucket", upto(F.col("buckets")))
    rows = entries.join(lists.repartition(tasks, *block).hint("merge"), block).withColumn("entry", entry).select(F.explode("scans").alias("s"), "peptide_id", "nr", "entry")
    columns = ("scan", "peptide_id", F.lit(True).alias("is_target"), "nr", "entry")
    rows = rows.withColumn("scan", F.col("s.scan")).select(*columns)
    # a scan with several windows is numbered over all of them
    several = scans.where("windows > 1")
    if several.isEmpty():
        return rows
    again = several.join(numbered.drop("nr"), ends).withColumn("copy", upto(F.col("n"))).withColumn("nr", by_peptide("scan")).withColumn("entry", entry)
    return rows.unionByName(again.select(*columns))
