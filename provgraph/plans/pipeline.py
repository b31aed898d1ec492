"""The whole affiliation pipeline (OP-33).

Stage order follows the original steps 1 -> 7.  A stage is a DataFrame; the
stages in ``WRITTEN``, those that several others read, are written as Parquet
below the shared work folder, in that order, by :func:`run`.  Reading one of
them on its own (as a single registered query does) writes it then.  A run that
publishes (:func:`run_and_publish`) also writes every result, straight to the
published folder: later stages read it there, and no stage is computed twice.

- ``commercial_grain``: the commercial claims by organisation role, ids
  resolved, scanned once for edges, totals and patients (the Medicare claims
  need no such table: edges and patients scan them, but for a publishing run,
  which writes what they share and scans the claims of a source once);
- ``medicare_edges``: read by the rollup and by the Medicare totals;
- ``affiliations``: the affiliation summary, read by decay, score, shares and
  assembly; the bounds of the scores are observed while it is written;
- ``dates``: the one-row analysis dates;
- ``assembled``: the table before the directory insert, read three times by
  OP-29.

Parquet scans prune columns and push filters; every dimension join is left to
the optimizer's size check (``spark.sql.autoBroadcastJoinThreshold``, AQE) as
long as the dimension is within that threshold by its rows, not only by its
packed files; beyond, it is a merge join (``sources.tables.lookup``).  Only
frames with a proven tiny bound (vintage selection, one-row dates) are
broadcast explicitly.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from provgraph.config import PipelineConfig
from provgraph.operators import assemble as asm
from provgraph.operators import decay as dec
from provgraph.operators import directory, edges, patients, rollup, scoring, shares
from provgraph.plans.publish import KEEP, Materializer, Publication
from provgraph.sources.catalog import newest_file
from provgraph.sources.tables import Sources, lookup


#: Roles that rows are joined with, and the columns of them if not all.
LOOKUPS = (("crosswalk",), ("physicians",), ("directory_physicians", "npi"), ("physician_groups",), ("surgery_centers",), ("imaging_centers",), ("companies",))
#: Stages that are written, in the order of their dependencies.
WRITTEN = ("commercial_grain", "medicare_edges", "affiliations", "dates", "assembled")
#: The same where nothing but the assembly reads the affiliations: they go from the edges to the
#: assembled table in the places they were dealt to, and the bounds of the scores are observed there.
FUSED = ("commercial_grain", "medicare_edges", "dates", "assembled")
#: Result tables that a full run publishes (OP-32): name, stage, and the part of a stage that holds several tables.
RESULTS: dict[str, tuple[str, str | None]] = {
    "commercial_billing_edges": ("commercial_edges", "org_role=billing"),
    "commercial_facility_edges": ("commercial_edges", "org_role=service_facility"),
    "medicare_attending_edges": ("medicare_edges", "role=attending"),
    "medicare_operating_edges": ("medicare_edges", "role=operating"),
    "medicare_rendering_edges": ("medicare_edges", "role=rendering"),
    "affiliation_summary": ("affiliations", None),
    "physician_totals_commercial": ("totals_commercial", None),
    "physician_totals_medicare": ("totals_medicare", None),
    "claim_shares": ("shares", None),
    "unique_patients_commercial": ("patients_commercial", None),
    "unique_patients_medicare": ("patients_medicare", None),
    "crosswalk_zero_filled": ("crosswalk_zero_filled", None),
    "hospital_affiliations": ("hospital_affiliations", None),
    "group_affiliations": ("group_affiliations", None),
    "surgery_center_affiliations": ("surgery_center_affiliations", None),
    "imaging_center_affiliations": ("imaging_center_affiliations", None),
    "affiliation_decay": ("decay", None),
    "affiliation_scores": ("scores", None),
    "final_affiliations": ("final", None),
}
#: Stages that a publishing run writes, each once, in the order of their dependencies.
PUBLISHED = (
    "commercial_grain", "commercial_edges", "medicare_grain", "medicare_edges", "affiliations", "totals_commercial", "totals_medicare",
    "patients_commercial", "crosswalk_zero_filled", "patients_medicare", "hospital_affiliations", "group_affiliations",
    "surgery_center_affiliations", "imaging_center_affiliations", "dates", "scored", "decay", "scores", "assembled", "shares", "final",
)


class AffiliationPipeline:
    def __init__(
        self,
        spark: SparkSession,
        sources: Sources,
        cfg: PipelineConfig,
        materialize: Materializer | None = None,
        written: tuple[str, ...] = WRITTEN,
        by_physician: bool = False,
    ):
        self.spark = spark
        self.src = sources
        self.cfg = cfg
        self.materialize = materialize if materialize is not None else Materializer(spark)
        self.written = written
        self.by_physician = by_physician
        self._lookups: dict[tuple[str, ...], DataFrame] = {}

    def _lookup(self, role: str, *columns: str) -> DataFrame:
        """A role, or columns of it, that rows are joined with (:func:`lookup`); its rows are counted once."""
        if (role, *columns) not in self._lookups:
            df = getattr(self.src, role)
            self._lookups[role, *columns] = lookup(df.select(*columns) if columns else df)
        return self._lookups[role, *columns]

    def check_inputs(self) -> None:
        """Company ids must be a key: a repeated one would silently multiply affiliations (Q8).  The rows of the lookups are counted before."""
        for role in LOOKUPS:
            self._lookup(*role)
        twice = self.src.companies.groupBy("hospital_id").count().filter("count > 1")
        if not twice.isEmpty():
            raise ValueError("hospital_id is not a key of the company dimension")

    def write_stages(self) -> None:
        for name in self.written:
            getattr(self, name)

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        return self.materialize(df, name) if name in self.written else df

    # ------------------------------------------------------------------ step 1: edges
    @cached_property
    def commercial_grain(self) -> DataFrame:
        return self._stage(edges.commercial_claim_grain(self.src.commercial_claims, self._lookup("crosswalk"), self.cfg), "commercial_grain")

    @cached_property
    def commercial_edges(self) -> DataFrame:
        """OP-01 + OP-02 in one pass, with an ``org_role`` column."""
        return self._stage(edges.commercial_edges_by_role(self.commercial_grain), "commercial_edges")

    @cached_property
    def medicare_files(self) -> DataFrame:
        """The (vintage, release) files: by the folders of the claims where they are partitioned so, else by the availability table."""
        files = self.src.medicare_files
        return self.src.medicare_availability.select("vintage", "release") if files is None else files

    @cached_property
    def medicare_clock(self) -> DataFrame:
        """The file that sets the Medicare analysis date, with its latest service date."""
        if self.src.medicare_files is None:
            return self.src.medicare_availability
        return newest_file(self.src.medicare_claims, self.medicare_files, self.cfg)

    @cached_property
    def vintages(self) -> DataFrame:
        return edges.select_vintages(self.medicare_files, self.cfg)

    @cached_property
    def medicare_grain(self) -> DataFrame:
        used = edges.selected_claims(self.src.medicare_claims, self.medicare_files, self.cfg)
        return self._stage(edges.medicare_claim_grain(used), "medicare_grain")

    @cached_property
    def medicare_events(self) -> DataFrame:
        return edges.medicare_events(self.medicare_grain)

    @cached_property
    def medicare_edges(self) -> DataFrame:
        """OP-05 + OP-06 + OP-07 in one pass, with a ``role`` column."""
        return self._stage(edges.medicare_edges_by_role(self.medicare_events), "medicare_edges")

    # ------------------------------------------------------------------ step 2: combine
    @cached_property
    def unified_edges(self) -> DataFrame:
        return self._unified()

    def _unified(self, features: DataFrame | None = None, companies: DataFrame | None = None) -> DataFrame:
        # With names, the organisations are joined with the companies first, whichever of the two is the smaller.
        crosswalk = self._lookup("crosswalk") if companies is None else self.src.crosswalk
        return rollup.unify_edges(self.commercial_edges, self.medicare_edges, self._lookup("physicians"), crosswalk, self.by_physician, features, companies)

    def _monthly(self, unified: DataFrame) -> DataFrame:
        return rollup.monthly_rollup(unified, self.src.claim_availability, self.cfg, self.by_physician)

    @cached_property
    def monthly(self) -> DataFrame:
        return self._monthly(self.unified_edges)

    @cached_property
    def affiliations(self) -> DataFrame:
        # Dealt by physician, the rows bring their companies' names; dealing the summary by company would move the widest rows.
        monthly = self._monthly(self._unified(companies=self._lookup("companies"))) if self.by_physician else self.monthly
        summary = rollup.affiliation_summary(monthly, self._lookup("companies"))
        if self.score_bounds is not None:
            summary = scoring.observe_score(summary, self.score_bounds)
        return self._stage(summary, "affiliations")

    @cached_property
    def score_bounds(self) -> Observation | None:
        """Least and greatest score, if the affiliations are written."""
        return Observation() if self.materialize.enabled and "affiliations" in self.written else None

    @cached_property
    def totals_commercial(self) -> DataFrame:
        return self._stage(shares.physician_totals_commercial(None, None, self.cfg, resolved=self.commercial_grain), "totals_commercial")

    @cached_property
    def totals_medicare(self) -> DataFrame:
        return self._stage(shares.physician_totals_medicare(self.medicare_edges), "totals_medicare")

    @cached_property
    def shares(self) -> DataFrame:
        if "assembled" in self.written and "shares" in self.written:
            # The assembly has them already.
            return self._stage(self.assembled.filter("has_totals").select(*shares.SHARE_COLUMNS), "shares")
        return self._stage(shares.claim_shares(self.affiliations, self.totals_commercial, self.totals_medicare), "shares")

    @cached_property
    def patients_commercial(self) -> DataFrame:
        return self._stage(patients.unique_patients_commercial(None, None, self.cfg, resolved=self.commercial_grain), "patients_commercial")

    @cached_property
    def patients_medicare(self) -> DataFrame:
        counted = patients.unique_patients_medicare(None, None, self._lookup("crosswalk"), self.cfg, grain=self.medicare_grain)
        return self._stage(counted, "patients_medicare")

    @cached_property
    def crosswalk_zero_filled(self) -> DataFrame:
        return self._stage(patients.crosswalk_zero_filled(self.src.crosswalk), "crosswalk_zero_filled")

    # ------------------------------------------------------------------ step 3: directory
    @cached_property
    def hospital_affiliations(self) -> DataFrame:
        return self._stage(directory.hospital_affiliations(self.src.directory_physicians, self._lookup("companies"), self.cfg.as_of), "hospital_affiliations")

    @cached_property
    def group_affiliations(self) -> DataFrame:
        groups = directory.group_affiliations(self.src.group_practice, self._lookup("directory_physicians", "npi"), self._lookup("companies"), self.cfg.as_of)
        return self._stage(groups, "group_affiliations")

    def _child_sites(self, sites: str) -> DataFrame:
        return directory.child_site_affiliations(
            self._lookup("directory_physicians", "npi"),
            self.src.group_practice,
            self._lookup("physician_groups"),
            self._lookup(sites),
            self._lookup("companies"),
            self.cfg.as_of,
        )

    @cached_property
    def surgery_center_affiliations(self) -> DataFrame:
        return self._stage(self._child_sites("surgery_centers"), "surgery_center_affiliations")

    @cached_property
    def imaging_center_affiliations(self) -> DataFrame:
        return self._stage(self._child_sites("imaging_centers"), "imaging_center_affiliations")

    # ------------------------------------------------------------------ steps 4-5: decay, score
    @cached_property
    def dates(self) -> DataFrame:
        return self._stage(dec.analysis_dates(self.src.claim_availability, self.medicare_clock, self.cfg), "dates")

    @cached_property
    def scored(self) -> DataFrame:
        """Affiliation summary + score + bucket + decay (all 1:1 per affiliation)."""
        return self._stage(self._with_score_and_decay(self.affiliations), "scored")

    def _with_score_and_decay(self, rows: DataFrame) -> DataFrame:
        bounds = self.score_bounds
        bucketed = scoring.with_score_bucket(scoring.with_score(rows), self.cfg, bounds)
        return dec.with_decay(bucketed, self.dates, self.cfg)

    @cached_property
    def decay(self) -> DataFrame:
        return self._stage(dec.decay_table(self.scored, self.cfg), "decay")

    @cached_property
    def scores(self) -> DataFrame:
        return self._stage(self.scored.select("physician_npi", "company_id", *scoring.SCORE_PARTS, "score", "score_bucket"), "scores")

    # ------------------------------------------------------------------ steps 6-7: assembly
    @cached_property
    def other_source_pairs(self) -> DataFrame:
        return asm.other_source_pairs(self.group_affiliations, self.hospital_affiliations)

    @cached_property
    def assembled(self) -> DataFrame:
        running = shares.physician_running_totals(self.totals_commercial, self.totals_medicare)
        if self.by_physician and "affiliations" not in self.written:
            return self._assembled_in_place(running)
        if "scored" in self.written:
            scored = self.scored
        else:
            # Scores and decay follow the join: their exchange carries the affiliations alone.
            scored, running = self._with_score_and_decay(shares.with_claim_shares(self.affiliations, running, "left")), None
        out = asm.assemble(scored, self.other_source_pairs, running, self.patients_commercial, self.patients_medicare, self.cfg)
        return self._stage(self._counted(out), "assembled")

    def _counted(self, assembled: DataFrame) -> DataFrame:
        """The same rows; their number is observed where they are written."""
        if self.assembled_rows is None:
            return assembled
        return assembled.observe(self.assembled_rows, F.count(F.lit(1)).alias("n"))

    @cached_property
    def assembled_rows(self) -> Observation | None:
        return Observation() if self.materialize.enabled and "assembled" in self.written else None

    def _assembled_in_place(self, running: DataFrame) -> DataFrame:
        """From the edges to the assembled rows, all dealt once, by physician; the buckets follow when the scores' bounds are known."""
        features = asm.feature_rows(self.other_source_pairs, self.patients_commercial, self.patients_medicare)
        # Names that can't be broadcast come along with the organisations; dealing the summary by company would move the widest rows.
        companies = self._lookup("companies")
        brought = None if companies is self.src.companies else companies
        summary = rollup.affiliation_summary(self._monthly(self._unified(features, brought)), companies)
        # Score, shares and decay have a sort between each other: one method of generated code for all of them is too long to be compiled.
        scored = shares.with_claim_shares(scoring.with_score(summary), running, "left")
        ranked = scored.withColumn("firm_type_rank", asm.firm_type_rank("score", self.cfg))
        out = asm.assemble(dec.with_decay(ranked, self.dates, self.cfg), None, None, None, None, self.cfg)
        bounds = Observation() if self.materialize.enabled and "assembled" in self.written else None
        if bounds is not None:
            out = scoring.observe_bounds(out, bounds)
        bucketed = scoring.with_score_bucket(self._stage(self._counted(out), "assembled"), self.cfg, bounds)
        return bucketed.select(*asm.ASSEMBLED_COLUMNS, "has_totals")

    @cached_property
    def assembled_pairs(self) -> DataFrame:
        """Keys of the assembled table; where it is written, joined with by their number."""
        pairs = self.assembled.select(*asm.KEY)
        return pairs if self.assembled_rows is None else lookup(pairs, self.assembled_rows.get["n"])

    @cached_property
    def directory_only(self) -> DataFrame:
        return asm.directory_only_rows(self.assembled, self.hospital_affiliations, self.group_affiliations, self.assembled_pairs)

    @cached_property
    def final(self) -> DataFrame:
        return self._stage(asm.finalize(self.assembled, self.hospital_affiliations, self.group_affiliations, self.cfg, self.assembled_pairs), "final")


def result(pipe: AffiliationPipeline, table: str) -> DataFrame:
    """A result table of :data:`RESULTS`, as the pipeline computes it."""
    stage, part = RESULTS[table]
    df = getattr(pipe, stage)
    if part is None:
        return df
    column, value = part.split("=", 1)
    return df.filter(F.col(column) == value).drop(column)


def run(spark: SparkSession, sources: Sources, cfg: PipelineConfig, materialize: bool = True) -> DataFrame:
    """OP-33: the final affiliation table (31 columns)."""
    pipe = AffiliationPipeline(spark, sources, cfg, Materializer(spark, enabled=materialize))
    pipe.check_inputs()
    pipe.write_stages()
    return pipe.final


def run_and_publish(
    spark: SparkSession, sources: Sources, cfg: PipelineConfig, out: str, mode: str = "overwrite", run_id: str | None = None, keep: int = KEEP
) -> None:
    """Every result table below ``out``, one folder each; the work folder is cleaned up afterwards.

    Every stage is written once and every table lists the files that its stage
    wrote.  ``append`` needs a ``run_id`` that names the load: a run that failed
    or is repeated replaces what it had added (see :func:`publish.commit`).
    """
    if mode == "append" and not run_id:
        raise ValueError("append needs a run id: it tells a repeated load from a new one")
    stages = {stage: [part.split("=", 1)[0]] if part else [] for stage, part in RESULTS.values()}
    writer = Publication(spark, out, stages, mode, run_id, keep)
    pipe = AffiliationPipeline(spark, sources, cfg, writer, PUBLISHED)
    try:
        pipe.check_inputs()
        pipe.write_stages()
        writer.commit(RESULTS)
    except BaseException:
        writer.abandon()
        raise
    finally:
        writer.remove()


__all__ = ["AffiliationPipeline", "PUBLISHED", "RESULTS", "result", "run", "run_and_publish"]
