"""Manifests of a release: a row a sample, file prefixes that no other prefix begins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sets import grid, prefix_shadows

SEPARATORS = "_-."


def versioned(template: Column, version: str) -> Column:
    """A template {d}<separator>rest with the version behind the dataset, under the
    template's own separator; an error if it has none. No version leaves it as it is."""
    if not version:
        return template
    separator = F.substring(template, 4, 1)
    fits = F.startswith(template, F.lit("{d}")) & (F.instr(F.lit(SEPARATORS), separator) > 0) & (F.length(template) > 3)
    wrong = F.raise_error(F.concat(F.lit("no dataset and separator at the start of "), template)).cast("string")
    return F.when(fits, F.concat(F.lit("{d}"), separator, F.lit(version), F.substring(template, F.lit(4), F.length(template)))).otherwise(wrong)


def manifest(datasets: DataFrame, samples: DataFrame, releases: tuple[str, ...], version: str = "") -> DataFrame:
    """patient, dataset, run_name, file_prefix, method, normal, group, alleles, platform,
    read_type, sample_type: a row for each dataset, sample and release.

    datasets: dataset, alleles, group; samples: label, method, normal, rna, full, subset (templates
    of file prefixes with {d} for the dataset), platform. The first release is the full one
    and keeps the dataset's name; others add theirs and take the subset's template."""
    kinds = datasets.sparkSession.range(len(releases)).select(F.get(F.array(*[F.lit(r) for r in releases]), F.col("id").cast("int")).alias("release"))
    d = grid(datasets, samples, kinds)  # lists of a design
    whole = F.col("release") == releases[0]
    template = versioned(F.when(whole, F.col("full")).otherwise(F.col("subset")), version)
    run = F.concat(F.when(F.col("normal"), "n").otherwise("a"), F.when(F.col("rna"), "r").otherwise("d"), F.lit("-"), F.replace("label", F.lit("_"), F.lit("-")))
    return d.select(
        F.col("dataset").alias("patient"), F.when(whole, F.col("dataset")).otherwise(F.concat_ws("-", "dataset", "release")).alias("dataset"), run.alias("run_name"),
        F.replace(template, F.lit("{d}"), F.col("dataset")).alias("file_prefix"), "method", "normal", "group", "alleles", "platform",
        F.when(F.col("platform") == "Illumina", "short-read").otherwise("long-read").alias("read_type"), F.when(F.col("normal"), "blood-normal").otherwise("tumor").alias("sample_type"))


def shadows(*manifests: DataFrame) -> DataFrame:
    """patient, shadowed, by: file prefixes of one patient that begin another of the same
    patient, over all manifests together (builds share one namespace). None is what must be."""
    names = manifests[0].select("patient", "file_prefix")
    for m in manifests[1:]:
        names = names.unionByName(m.select("patient", "file_prefix"))
    keyed = names.select(F.concat_ws("\x1f", "patient", "file_prefix").alias("name"))
    found = prefix_shadows(keyed, "name").where(F.instr("shadowed", "\x1f") > 0)
    cut = lambda c, i: F.get(F.split(c, "\x1f"), F.lit(i))
    return found.select(cut("shadowed", 0).alias("patient"), cut("shadowed", 1).alias("shadowed"), cut("by", 1).alias("by"))


def guarded(manifest: DataFrame, *others: DataFrame) -> DataFrame:
    """manifest, or an error that names prefixes which shadow each other, in it or with
    those of other builds."""
    found = shadows(manifest, *others).limit(5).collect()
    if found:
        raise ValueError("file prefixes shadow each other: " + "; ".join(f"{r.patient}: {r.shadowed} begins {r.by}" for r in found))
    return manifest
