"""The streaming erasure as a job for ``spark-submit``.

    spark-submit veil/streaming/job.py --requests /in --table clients --checkpoint /checkpoints/clients
    spark-submit veil/streaming/job.py --requests /in --cells /data/cells --checkpoint /checkpoints/cells
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from veil.operators.erase import KINDS, MASKS, PERSONAL_FAMILY
from veil.runtime import build_session
from veil.streaming.erasure import run_cell_stream, run_log_stream, run_stream


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Erase the keys that arrive as text files.")
    parser.add_argument("--requests", required=True, help="folder of request files, key first in each line")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--table", help="bucketed table: a path or a catalog name")
    target.add_argument("--cells", help="path of a cell table")
    parser.add_argument("--checkpoint", required=True, help="shared folder for progress and ledger")
    parser.add_argument("--key", default="bp", help="key column")
    parser.add_argument("--buckets", type=int, help="expected number of buckets; another one is refused")
    parser.add_argument("--mask", action="append", metavar="COLUMN=TEXT", help="mask; may be repeated")
    parser.add_argument("--family", default=PERSONAL_FAMILY, help="family of the masked cells")
    parser.add_argument("--delete", action="store_true", help="delete rows or cells instead of masking them")
    parser.add_argument("--kind", choices=sorted(KINDS), default="mask", help="what the requests ask for in a table")
    parser.add_argument("--log", help="request log of the table: requests hold at once for readers of its view")
    parser.add_argument("--compact-every", type=int, help="with --log: batches after which files are rewritten")
    parser.add_argument("--once", action="store_true", help="handle what is there, then stop")
    args = parser.parse_args(argv)
    if args.cells and args.buckets:
        parser.error("--buckets goes with --table")
    if args.cells and (args.log or args.kind != "mask"):
        parser.error("--log and --kind go with --table")
    args.kind = "delete" if args.delete else args.kind
    args.masks = dict(m.split("=", 1) for m in args.mask) if args.mask else dict(MASKS)
    return args


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session("veil-erasure")
    if args.log:
        query = run_log_stream(spark, args.requests, args.table, args.log, args.checkpoint, args.key, args.masks,
                               kind=args.kind, compact_every=args.compact_every, once=args.once)
    elif args.table:
        query = run_stream(spark, args.requests, args.table, args.checkpoint, args.key, args.buckets, args.masks,
                           kind=args.kind, once=args.once)
    else:
        query = run_cell_stream(spark, args.requests, args.cells, args.checkpoint, args.key, args.masks,
                                family=args.family, delete=args.delete, once=args.once)
    query.awaitTermination()


if __name__ == "__main__":
    main()
