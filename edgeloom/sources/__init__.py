"""Where edges come from and where results go."""

from edgeloom.sources.generate import SINK, chain_edges, chain_graph, chain_vertices, initial_ranks, numbered_vertices
from edgeloom.sources.sinks import format_pairs, write_labelled, write_pairs
from edgeloom.sources.single import write_single_file
from edgeloom.sources.tables import edges_from, follows, follows_dense, follows_skewed, table
from edgeloom.sources.text import parse_edges, parse_ranks, parse_vertices, read_edges, read_ranks, read_vertices

__all__ = [
    "SINK", "chain_edges", "chain_graph", "chain_vertices", "edges_from", "follows", "follows_dense", "follows_skewed",
    "format_pairs", "initial_ranks", "numbered_vertices", "parse_edges", "parse_ranks", "parse_vertices", "read_edges", "read_ranks",
    "read_vertices", "table", "write_labelled", "write_pairs", "write_single_file",
]
