"""Programs over text files: ``spark-submit run_edgeloom.py <program> ...``.

Each program reads edge files, runs one operator and writes text. The session comes
from ``spark-submit``, with its master and settings.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

import edgeloom as el
from edgeloom.operators.pagerank import NORMALIZE
from edgeloom.operators.triangles import MULTIPLICITIES
from edgeloom.plans import STRATEGIES
from edgeloom.sources.text import SCANS


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="edgeloom", description=__doc__)
    programs = top.add_subparsers(dest="program", required=True)

    def program(name: str, help: str) -> argparse.ArgumentParser:
        p = programs.add_parser(name, help=help)
        p.add_argument("input", help="edge files: 'follower,user' words separated by blanks")
        p.add_argument("output", help="folder to write")
        p.add_argument("--mode", choices=("fail", "drop"), default="fail", help="for malformed words")
        p.add_argument("--sep", default=",", help="between key and value")
        p.add_argument("--scan", choices=SCANS, default="lines", help="what a record ends at; by blanks, lines may be of any length")
        p.add_argument("--style", choices=("delimited", "tuple", "csv"), default="delimited")
        if name != "max-filter":  # which compares ids as numbers
            p.add_argument("--ids", choices=("bigint", "string"), default="bigint")
        return p

    p = program("followers", "followers of each user")
    p.add_argument("--sort-keys", action="store_true", help="order each file by user as text")
    p = program("max-filter", "edges with both ids below a bound")
    p.add_argument("max_id", type=int)
    p = program("two-path-count", "number of two-paths")
    p.add_argument("max_id", type=int, nargs="?")
    p = program("triangle-count", "number of directed triangles")
    p.add_argument("max_id", type=int, nargs="?")
    p.add_argument("--multiplicity", choices=MULTIPLICITIES, default="distinct")
    p.add_argument("--strategy", choices=(*STRATEGIES, "lists"), default="auto")
    p = program("pagerank", "ranks; the input folder holds graph.txt, vertex.txt and rank.txt")
    p.add_argument("iterations", type=int)
    p.add_argument("--sink", default=str(el.SINK))
    p.add_argument("--n", type=int, help="vertices that share the spread, by default all but the sink")
    p.add_argument("--resume", metavar="FOLDER", help="keep finished steps there, and go on from them")
    p.add_argument("--normalize", choices=NORMALIZE, default="none")

    p = programs.add_parser("chains", help="write graph.txt, vertex.txt and rank.txt of k chains of k")
    p.add_argument("output")
    p.add_argument("k", type=int)
    return top


def run(spark: SparkSession, argv: list[str]) -> None:
    top = parser()
    args = top.parse_args(argv)
    if getattr(args, "ids", "bigint") == "string" and getattr(args, "max_id", None) is not None:
        top.error("a bound on ids needs --ids bigint")
    if args.program == "chains":
        vertices = el.chain_vertices(el.numbered_vertices(spark, args.k))
        el.write_pairs(el.chain_graph(spark, args.k), f"{args.output}/graph.txt")
        el.write_pairs(vertices.selectExpr("v", "0 AS unused"), f"{args.output}/vertex.txt")
        el.write_pairs(el.initial_ranks(vertices, args.k * args.k), f"{args.output}/rank.txt")
        return

    text = {"sep": args.sep, "style": args.style}
    if args.program == "pagerank":
        ranks = el.pagerank(
            el.read_edges(spark, f"{args.input}/graph.txt", args.mode, args.ids, args.scan),
            el.read_vertices(spark, f"{args.input}/vertex.txt", args.mode, args.ids, args.scan),
            args.iterations, sink=args.sink if args.ids == "string" else int(args.sink), n=args.n,
            normalize=args.normalize, resume=args.resume, ranks=el.read_ranks(spark, f"{args.input}/rank.txt", args.mode, args.ids, args.scan),
        )
        el.write_pairs(ranks, args.output, **text)
        return

    edges = el.read_edges(spark, args.input, args.mode, getattr(args, "ids", "bigint"), args.scan)
    if getattr(args, "max_id", None) is not None:
        edges = el.max_filter(edges, args.max_id)
    if args.program == "followers":
        el.write_pairs(el.follower_count(edges), args.output, sort_keys=args.sort_keys, **text)
    elif args.program == "max-filter":
        el.write_pairs(edges, args.output, **text)
    elif args.program == "two-path-count":
        el.write_labelled(el.two_path_count(edges), args.output, "two-paths", **text)
    else:
        count = el.triangle_count(edges, args.multiplicity, args.strategy)
        el.write_labelled(count, args.output, "triangles", **text)
