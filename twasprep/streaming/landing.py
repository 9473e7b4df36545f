"""Landing-folder processing with Structured Streaming.

The streaming checkpoint records which input files were consumed, which
replaces "skip the output if it already exists": a rerun picks up only new
files, and a failed micro-batch is retried from the checkpoint.

* ``stream_row_local``: stateless row-local operators (dosage mapping, bin
  means, id rewrites) run directly on the stream.
* ``run_file_batches``: operators that need whole files (a VCF header, a
  per-sample statistic) run in ``foreachBatch`` on the micro-batch's new
  files, re-read as a static DataFrame; outputs are written per epoch with
  overwrite so a retried epoch replaces its own partial output. The stream
  itself carries file names only: no file is opened to learn that it is there
  (Spark leaves files without a byte out of any scan; they hold no rows).
* ``stream_scores``: samples are normalised and scored once all of their files
  have landed; what has landed and what is scored is kept per batch, so a batch
  that is run again writes the same rows to the same place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from twasprep.operators import predict as P
from twasprep.operators.features import region_bin_means
from twasprep.schemas import REGION_TENSORS
from twasprep.sources.text import decoded_path, sample_from_path


def stream_row_local(spark: SparkSession, source_dir: str, schema: StructType,
                     transform: Callable[[DataFrame], DataFrame], sink_dir: str,
                     checkpoint_dir: str, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None):
    """Apply a row-local DataFrame transform to every new file; returns the
    finished query (``availableNow``: all pending files, then stop)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = transform(reader.load(source_dir))
    q = (out.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_dir).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def stream_bin_means(spark: SparkSession, tensors_dir: str, sink_dir: str, checkpoint_dir: str):
    """Region tensors landing (Parquet) -> region features, incrementally."""
    return stream_row_local(spark, tensors_dir, REGION_TENSORS, region_bin_means, sink_dir,
                            checkpoint_dir)


#: Columns of the file listing; ``content`` is never asked for, so no file is opened.
_FILES = "path string, modificationTime timestamp, length long, content binary"


def _landing_files(spark: SparkSession, landing_dir: str, path_glob: str | None,
                   max_files_per_trigger: int) -> DataFrame:
    """A stream of the paths (and lengths) of new files."""
    reader = (spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return reader.load(landing_dir).select("path", "length")


def run_file_batches(spark: SparkSession, landing_dir: str, checkpoint_dir: str,
                     process: Callable[[SparkSession, list[str], int], None],
                     path_glob: str | None = None, max_files_per_trigger: int = 64):
    """Call ``process(spark, new_file_paths, epoch_id)`` for each micro-batch.

    Only the names of the batch's new files reach the driver (bounded by
    ``max_files_per_trigger``); ``process`` re-reads them with the batch
    readers, so whole-file operators keep their batch semantics.
    """
    files = _landing_files(spark, landing_dir, path_glob, max_files_per_trigger)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        paths = [r.path for r in batch.select("path").distinct().collect()]
        if paths:
            process(spark, sorted(paths), epoch_id)

    q = (files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def stream_vcf_landing(spark: SparkSession, landing_dir: str, samples_path: str, out_dir: str,
                       checkpoint_dir: str, reformat: bool = True,
                       max_files_per_trigger: int = 22):
    """New VCF files in a landing folder -> dosage matrix + variant
    annotation under ``out_dir/epoch=<n>``. A retried epoch overwrites its
    own folder, so reruns never duplicate rows."""
    from twasprep.plans.workflows import extract_genotypes

    def process(s: SparkSession, paths: list[str], epoch_id: int) -> None:
        extract_genotypes(s, paths, samples_path, f"{out_dir.rstrip('/')}/epoch={epoch_id}",
                          reformat=reformat, mode="overwrite")

    return run_file_batches(spark, landing_dir, checkpoint_dir, process,
                            max_files_per_trigger=max_files_per_trigger)


class SampleScores:
    """State and output of :func:`stream_scores` under one folder.

    ``arrived/batch=<id>``: files of that batch and their samples;
    ``predictions/batch=<id>``: rows of the samples that it completed;
    ``scored/batch=<id>``: those samples with their genes and predictions.
    """

    def __init__(self, spark: SparkSession, out_dir: str, expected: DataFrame, scorer,
                 sample_of: Callable[[Column], Column]):
        self.spark, self.base = spark, out_dir.rstrip("/")
        self.expected, self.scorer, self.sample_of = expected, scorer, sample_of

    def _read(self, name: str, schema: str) -> DataFrame:
        from twasprep.plans.workflows import _exists

        path = f"{self.base}/{name}"
        if not _exists(self.spark, path):
            return self.spark.createDataFrame([], f"{schema}, batch long")
        return self.spark.read.schema(f"{schema}, batch long").parquet(path)

    def arrived(self) -> DataFrame:
        return self._read("arrived", "sample_id string, path string")

    def scored(self) -> DataFrame:
        return self._read("scored", "sample_id string, genes long, predictions long")

    def predictions(self) -> DataFrame:
        return self._read("predictions", "sample_id string, gene_name string, cell_type string, prediction double")

    def batch(self, files: DataFrame, batch_id: int) -> None:
        """Take in one batch. All that it does follows from the files of batches
        up to its own and the samples scored before it, so a second run of a batch
        overwrites its folders with the same rows."""
        files.select(self.sample_of(F.col("path")).alias("sample_id"), "path").distinct() \
            .write.mode("overwrite").parquet(f"{self.base}/arrived/batch={batch_id}")
        here = self.arrived().where(F.col("batch") <= batch_id).select("sample_id", "path").distinct()
        before = self.scored().where(F.col("batch") < batch_id).select("sample_id")
        ready = (here.groupBy("sample_id").agg(F.count(F.lit(1)).alias("here")).join(self.expected, "sample_id")
                 .where(F.col("here") >= F.col("files")).join(before, "sample_id", "left_anti"))
        # the new samples' files: a bounded number of files of each of a batch's samples
        paths = [r.path for r in here.join(ready, "sample_id", "left_semi").select("path").toLocalIterator()]
        if not paths:
            return
        rows = self.spark.read.schema("gene_name string, features array<double>, ord long").parquet(*sorted(paths))
        feats = rows.select(self.sample_of(decoded_path()).alias("sample_id"), "gene_name", "features", "ord")
        preds = P.predict_expression(P.zscore_features(feats), self.scorer)
        out = f"{self.base}/predictions/batch={batch_id}"
        preds.write.mode("overwrite").parquet(out)
        written = self.spark.read.schema(preds.schema).parquet(out)
        kept = P.row_conservation(P.distinct_genes(feats), written, len(self.scorer.cell_types))
        P.require_conserved(kept)
        kept.select("sample_id", F.col("genes"), F.col("predictions")).write.mode("overwrite").parquet(
            f"{self.base}/scored/batch={batch_id}")


def stream_scores(spark: SparkSession, landing_dir: str, expected: DataFrame, scorer, out_dir: str,
                  checkpoint_dir: str, sample_of: Callable[[Column], Column] | None = None,
                  max_files_per_trigger: int = 64) -> SampleScores:
    """Score every sample whose feature files (Parquet) have all landed.

    ``expected``: ``(sample_id, files)``. ``sample_of`` gives a path's sample
    (default: the ``sample_id=<id>`` folder, else the name up to its first dot).
    Runs over what is pending and returns the state; call it again as files land."""
    state = SampleScores(spark, out_dir, expected, scorer, sample_of or sample_from_path)
    files = _landing_files(spark, landing_dir, "*.parquet", max_files_per_trigger)
    q = (files.writeStream.foreachBatch(state.batch).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return state
