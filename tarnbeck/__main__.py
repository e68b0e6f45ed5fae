"""python -m tarnbeck --prefix PATH | --key PATH --out PATH: ingest objects and write records, vectors and a manifest."""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from .config import EngineConfig
from .operators import index
from .plans.ingest import ingest, write
from .sources.media import Tools, media_documents
from .sources.objects import choose
from .storage import install


def main(argv: list[str] | None = None, spark: SparkSession | None = None, tools: Tools | None = None) -> int:
    """0, or 1 if any object failed. Which tools there are is code, not an option: pass them in."""
    parser = argparse.ArgumentParser(prog="tarnbeck", description=__doc__)
    parser.add_argument("--prefix", help="everything below this path")
    parser.add_argument("--key", help="this object alone; wins over a prefix")
    parser.add_argument("--out", required=True, help="folder for records, vectors and manifests")
    args = parser.parse_args(argv)
    if not args.prefix and not args.key:
        parser.error("a key or a prefix is needed")
    spark = spark or SparkSession.builder.appName("tarnbeck").getOrCreate()
    install(spark)
    config, tools = EngineConfig.from_env(), tools or Tools()
    result = ingest(media_documents(choose(spark, args.prefix, args.key), config, tools), config, tools=tools)
    write(result, args.out, datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ"), config)
    told = index.run_summary(result.manifest).first()
    print(" ".join(f"{k}={v}" for k, v in told.asDict().items()))
    return int(told["failed"] > 0)


if __name__ == "__main__":
    sys.exit(main())
