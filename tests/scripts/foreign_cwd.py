"""Load the entry file by path from another directory and run queries that use Python workers."""

import importlib.util
import json
import os
import sys

from pyspark.sql import SparkSession

spec = importlib.util.spec_from_file_location("entry_under_test", os.path.join(sys.argv[1], "__spark_entry__.py"))
E = importlib.util.module_from_spec(spec)
spec.loader.exec_module(E)

spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
out = {name: E.queries()[name](spark, "/root/testdata/sf0.001").count()
       for name in ("raw_landing", "xml_discovered_tags")}
print(json.dumps(out))
