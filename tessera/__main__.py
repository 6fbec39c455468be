"""Command line: ``python -m tessera CONFIG --catalog DIR [--input DIR ...] [--once]``.

Reads the same JSON configuration keys as the reference service. With
``--once`` (or ``"test mode": true``) the posted files are processed once;
otherwise the folders are watched with Structured Streaming.
"""

from __future__ import annotations

import argparse
import hashlib
import json
import os

from tessera.plans.service import run_batch, serve
from tessera.session import get_spark
from tessera.spec import CatalogSpec


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tessera")
    ap.add_argument("config")
    ap.add_argument("--catalog", required=True)
    ap.add_argument("--input", action="append", default=None)
    ap.add_argument("--once", action="store_true")
    ap.add_argument("--stream", action="store_true")
    ap.add_argument("--master", default=None)
    ap.add_argument("--checkpoint", default=None, help="shared folder for the stream's progress; needed with --stream "
                                                       "unless spark.checkpoint.dir is set")
    ap.add_argument("--encodings", default=None, help="Parquet folder of a model from sources.encodings.learn_encodings; "
                                                      "finds the encoding of text files without a byte order mark")
    args = ap.parse_args(argv)
    spec = CatalogSpec.from_config(args.config)
    inputs = args.input or spec.post_folders
    spark = get_spark(args.master)
    encodings = spark.read.parquet(args.encodings) if args.encodings else None
    if args.stream:
        tag = hashlib.sha1(os.path.abspath(args.catalog).encode()).hexdigest()[:16]
        root = args.checkpoint or spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            ap.error("--stream needs --checkpoint or spark.checkpoint.dir: a restart must find the same folder again")
        ck = os.path.join(root, "stream", tag)
        serve(spark, spec, inputs, args.catalog, ck, once=args.once or spec.test_mode, encodings=encodings)
    else:
        print(json.dumps(run_batch(spark, spec, inputs, args.catalog, encodings=encodings)))


if __name__ == "__main__":
    main()
