"""Settings that bound what a step takes at once."""

from sluice.session import apply_conf


def test_files_are_looked_up_by_a_bounded_number_of_tasks(spark):
    apply_conf(spark)
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 64
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "8388608b"
