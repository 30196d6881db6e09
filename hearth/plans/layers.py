"""Materialised silver layer.

Gold reports read silver tables that are written once, as the medallion
design intends: the latest-record dedup, the recommendation join and the
lettings ingest run once per input snapshot instead of once per report.
Written tables also cut the lineage, so a lost executor costs a re-read of
silver, not a replay of the ingest, and report plans stay small.

Tables live under the shared folder named by ``spark.checkpoint.dir`` (see
``hearth.session``), keyed by a fingerprint of the input files (path, size,
modification time), so a changed input is rebuilt, never served stale. Versions
are published through a manifest (``sources.snapshots``), so readers never see
a half-written table, two writers at once give one table, and old versions go.
"""

from __future__ import annotations

import hashlib
from importlib import resources

from pyspark.sql import DataFrame, SparkSession

from ..functions import columns as C
from ..session import scratch_path
from ..sources import snapshots
from ..sources.readers import _fs
from ..sources.tables import DRIVER_TABLES

CERT_PARTITION = "borough"
LETTINGS_PARTITION = "year"


#: Packages whose code the tables depend on.
BUILT_BY = ("functions", "operators", "plans", "sources")

# Extra salt for the fingerprint; a benchmark sets it to force a fresh build.
RUN_TAG = ""


def _code_version() -> str:
    """Hash of the source of the packages that build these tables: a code change never reuses tables built by older code.

    Read through the import system, so that it is the same from a folder and from a zip file.
    """
    h, package = hashlib.sha1(), __name__.split(".")[0]
    for part in BUILT_BY:
        for item in sorted(resources.files(f"{package}.{part}").iterdir(), key=lambda f: f.name):
            if item.name.endswith(".py"):
                h.update(f"{part}/{item.name}".encode())
                h.update(item.read_bytes())
    return h.hexdigest()[:12]


CODE_VERSION = _code_version()


# Driver tables each layer is derived from (its fingerprint covers only these).
SOURCES = {
    "certificates": ("orders", "customer", "nation"),
    "homes": ("orders", "customer", "nation"),
    "retrofit_base": ("orders", "customer", "nation", "lineitem"),
    "recommended": ("orders", "customer", "nation", "lineitem"),
    "retrofit_rollup": ("orders", "customer", "nation", "lineitem"),
    "lettings": ("events",),
}


def _fingerprint(spark: SparkSession, sf_dir: str, tag: str, tables=DRIVER_TABLES) -> str:
    h = hashlib.sha1(f"{sf_dir}|{tag}|{RUN_TAG}|{CODE_VERSION}".encode())
    for t in sorted(tables):
        fs, path = _fs(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")
        if not fs.exists(path):
            continue
        files, sizes = fs.listFiles(path, True), []   # all levels of a partitioned folder; a file lists itself
        while files.hasNext():
            f = files.next()
            sizes.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        h.update(repr((t, sorted(sizes))).encode())
    return h.hexdigest()[:16]


def _place(spark: SparkSession, sf_dir: str, name: str, tag: str) -> tuple[str, str]:
    """(folder, fingerprint of the present input) of the silver table ``name``."""
    where = hashlib.sha1(f"{sf_dir}|{tag}".encode()).hexdigest()[:16]
    return scratch_path(spark, f"silver/{where}/{name}"), _fingerprint(spark, sf_dir, f"{name}|{tag}", SOURCES.get(name, DRIVER_TABLES))


def materialise(spark: SparkSession, sf_dir: str, name: str, build, partition_by: str | None = None,
                tag: str = "") -> DataFrame:
    """The silver table ``name`` of the present input, behind a manifest: a changed input publishes a new version."""
    where, inputs = _place(spark, sf_dir, name, tag)
    return snapshots.table(spark, where, build, inputs, partition_by)


def certificates(spark: SparkSession, sf_dir: str, tag: str = "") -> DataFrame:
    from .silver import certificates_silver
    return materialise(spark, sf_dir, "certificates", lambda: certificates_silver(spark, sf_dir),
                       CERT_PARTITION, tag)


#: What the area, retrofit and reach reports read of a certificate.
HOME_COLUMNS = ("certificate_id", "borough", "epc_rating", "epc_score", "epc_potential", "construction_age_band", "property_type",
                "co2_emissions", "below_epc_c")


def homes(spark: SparkSession, sf_dir: str, tag: str = "") -> DataFrame:
    """The rows of ``certificates`` with ``HOME_COLUMNS`` only, written as the dedup leaves them.

    The latest certificate is found by a sort in the scan's tasks and one behind the shuffle: narrow rows keep both in memory
    where the wide ones of all columns spill, and no folder per area deals them out and sorts them again.
    """
    from .silver import certificates_silver
    return materialise(spark, sf_dir, "homes", lambda: certificates_silver(spark, sf_dir).select(*HOME_COLUMNS), None, tag)


def retrofit_base(spark: SparkSession, sf_dir: str, tag: str = "") -> DataFrame:
    """Recommendations ⋈ in-scope certificates, costs parsed, category / tier / age group added.

    Written as the join leaves it: a folder per area would deal every wide row out again and sort it before the write.
    """
    from .silver import joined_recommendations

    def build():
        return (joined_recommendations(spark, sf_dir, homes(spark, sf_dir, tag))
                .withColumn("category", C.category("improvement_type"))
                .withColumn("work_tier", C.work_tier("cost_mid"))
                .withColumn("age_group", C.age_group("construction_age_band")))
    return materialise(spark, sf_dir, "retrofit_base", build, None, tag)


def recommended(spark: SparkSession, sf_dir: str, tag: str = "") -> DataFrame:
    """(certificate_id, improvement_type) of the rows of ``retrofit_base``, for readers of no other column.

    Read from that table if it is there; else the join is written with these two columns, and no cost is moved or parsed.
    """
    from .silver import joined_recommendations
    columns = ("certificate_id", "improvement_type")
    where, inputs = _place(spark, sf_dir, "retrofit_base", tag)
    there = snapshots.Snapshots(spark, where).newest()
    if there is not None and there["inputs"] == inputs:
        return retrofit_base(spark, sf_dir, tag).select(*columns)
    return materialise(spark, sf_dir, "recommended",
                       lambda: joined_recommendations(spark, sf_dir, homes(spark, sf_dir, tag)).select(*columns), None, tag)


def retrofit_rollup(spark: SparkSession, sf_dir: str, tag: str = "") -> DataFrame:
    """Counts and cost sums of the joined recommendations, which most retrofit reports add up.

    Added up behind the join itself, so that only the columns of the sums are shuffled and no table of single rows is written.
    """
    from .retrofit import rollup
    from .silver import joined_recommendations

    def build():
        return rollup(joined_recommendations(spark, sf_dir, homes(spark, sf_dir, tag))
                      .withColumn("category", C.category("improvement_type"))
                      .withColumn("work_tier", C.work_tier("cost_mid")))
    return materialise(spark, sf_dir, "retrofit_rollup", build, None, tag)


def lettings(spark: SparkSession, sf_dir: str, tag: str = "") -> DataFrame:
    from .lettings import lettings_silver
    return materialise(spark, sf_dir, "lettings", lambda: lettings_silver(spark, sf_dir),
                       LETTINGS_PARTITION, tag)
