"""Command line: ``python -m emporia <command> ...``.

Commands:
  run-all <sf_dir> <out_root>       all results of the driver tables, published
  query <sf_dir> <name> [<out>]     one registered query (shown, or written as Parquet)
  list                              registered query names
"""

from __future__ import annotations

import sys


def main(argv: list[str]) -> int:
    if not argv or argv[0] in ("-h", "--help"):
        print(__doc__)
        return 0
    from emporia.plans import registry

    cmd = argv[0]
    if cmd == "list":
        for name in sorted(registry.queries()):
            print(name)
        return 0

    from pyspark.sql import SparkSession

    from emporia.session import SCALE_CONF, ensure_checkpoint_dir

    builder = SparkSession.builder.appName(f"emporia-{cmd}")
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    try:
        if cmd == "run-all":
            from emporia.plans.batch import run_all
            from emporia.sources.fixtures import load_sources

            out = run_all(spark, load_sources(spark, argv[1]), argv[2])
            for name, where in sorted(out.items()):
                print(f"{name}\t{where}")
        elif cmd == "query":
            df = registry.queries()[argv[2]](spark, argv[1])
            if len(argv) > 3:
                df.write.mode("overwrite").parquet(argv[3])
            else:
                df.show(20, truncate=False)
        else:
            print(__doc__)
            return 2
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
