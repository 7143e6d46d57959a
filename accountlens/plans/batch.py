"""End-to-end batch run: load -> validate + gate -> segment -> write -> profile -> audit."""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.sql import SparkSession

from accountlens import constants as C
from accountlens.operators import quality as dq
from accountlens.operators.profiles import segment_profile_report
from accountlens.operators.segmentation import RFMSegmenter
from accountlens.session import materialize
from accountlens.sources.files import write_profiles, write_segmented
from accountlens.sources.loaders import DataLoader

log = logging.getLogger(__name__)


def run_pipeline(spark: SparkSession, raw_dir: str, processed_dir: str, as_of, *,
                 employers_file: str = "employers.csv", interactions_file: str = "interactions.csv",
                 skip_validation: bool = False, strict_interactions: bool = False,
                 n_segments: int = C.KMEANS_N_SEGMENTS, salt: str | None = None, run_date=None,
                 output_format: str = "parquet", drop_pii: bool = False, segmenter_params: dict | None = None) -> dict:
    """Run the whole flow and return the written paths, the reports and the fitted model.

    Failing employer checks raise ``DataQualityError``; failing interaction checks
    only warn unless ``strict_interactions``. The contracts always run at load.
    """
    run_date = run_date or _dt.date.today()
    loader = DataLoader(spark, raw_dir, salt=salt, processed_at=_dt.datetime.now().isoformat())
    employers = loader.load_employers(employers_file)
    interactions = loader.load_interactions(interactions_file)

    reports = {}
    if not skip_validation:
        emp_report = dq.ValidationReport.collect(dq.validate_employers(employers, as_of))
        int_report = dq.ValidationReport.collect(dq.validate_interactions(interactions, as_of, employers))
        reports = {"employers": emp_report, "interactions": int_report}
        log.info(emp_report.summary())
        log.info(int_report.summary())
        dq.gate(emp_report, strict=True)
        if not int_report.passed:
            if strict_interactions:
                dq.gate(int_report, strict=True)
            log.warning("interaction checks failed; continuing")

    # one materialisation of the cleaned employer table feeds the fit and the scoring
    employers = materialize(employers)
    model = RFMSegmenter(asOf=str(as_of), nSegments=n_segments, **(segmenter_params or {})).fit(employers)
    segmented = model.transform(employers)
    segmented_path = write_segmented(segmented, processed_dir, run_date, output_format, drop_pii=drop_pii)

    written = spark.read.parquet(segmented_path) if output_format == "parquet" else segmented
    profiles = segment_profile_report(written)
    profiles_path = write_profiles(profiles, processed_dir)
    audit_path = loader.audit.save(processed_dir)
    return {"segmented": segmented_path, "profiles": profiles_path, "audit": audit_path,
            "reports": reports, "model": model}
