"""Command line: export a graph, partition it, or fit a classifier on it.

    spark-submit -m hetgraph ...   or   python -m hetgraph export --dt 2024-01-01 --output DIR
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from hetgraph.operators.partition import METHODS, read_hosts
from hetgraph.plans import jobs
from hetgraph.schema import EdgeType, GraphConfig, TrainConfig
from hetgraph.sinks.store import GraphStore
from hetgraph.sources.tables import table_reader


def parse(argv=None) -> argparse.Namespace:
    top = argparse.ArgumentParser(prog="hetgraph")
    sub = top.add_subparsers(dest="command", required=True)

    e = sub.add_parser("export", help="scan one snapshot and write the graph layout")
    e.add_argument("--dt", required=True)
    e.add_argument("--output", required=True)
    e.add_argument("--database", default="graph_db")
    e.add_argument("--node-types", default="user,item")
    e.add_argument("--edge-types", default="user:click:item,user:purchase:item,item:similar:item")
    e.add_argument("--num-partitions", type=int, default=32)
    e.add_argument("--with-reverse", action="store_true")

    p = sub.add_parser("partition", help="partition a written graph")
    p.add_argument("--graph", required=True)
    p.add_argument("--num-partitions", type=int, default=32)
    p.add_argument("--method", choices=[*METHODS, "balanced"], default="random")
    p.add_argument("--hosts", help="file with one host per line")
    p.add_argument("--per-host", type=int, default=1)

    t = sub.add_parser("train", help="fit a classifier on propagated features")
    t.add_argument("--graph", required=True)
    t.add_argument("--target", default="user")
    t.add_argument("--dim", type=int, required=True, help="length of the feature vectors")
    t.add_argument("--rounds", type=int, default=2)
    return top.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace):
    if args.command == "export":
        config = GraphConfig(
            node_types=tuple(args.node_types.split(",")),
            edge_types=tuple(EdgeType(*e.split(":")) for e in args.edge_types.split(",")),
            output_path=args.output,
            num_partitions=args.num_partitions,
            with_reverse=args.with_reverse,
        )
        return jobs.export_graph(spark, table_reader(spark, args.database), config, args.dt)
    store = GraphStore(spark, args.graph)
    if args.command == "partition":
        hosts = read_hosts(spark, args.hosts) if args.hosts else None
        return jobs.partition_graph(store, args.num_partitions, args.method, hosts, args.per_host)
    config, store = TrainConfig(target_node_type=args.target), store.pinned()
    return jobs.train_best(store.read_nodes(), store.read_edges(), args.dim, config, args.rounds)


def main() -> None:
    args = parse()
    spark = SparkSession.builder.appName(f"hetgraph-{args.command}").enableHiveSupport().getOrCreate()
    result = run(spark, args)
    if args.command == "export":
        print(result)
    elif args.command == "partition":
        for name, table in result.items():
            print(name)
            table.show(1000, truncate=False)
    else:
        print("rounds of propagation:", result.best_rounds)
        result.report.show(truncate=False)


if __name__ == "__main__":
    main()
