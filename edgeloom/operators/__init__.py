"""Graph operators: DataFrame in, DataFrame out."""

from edgeloom.operators.degrees import degrees, follower_count, two_path_count, two_path_degree
from edgeloom.operators.edges import edge_multiplicity, max_filter, reverse_edges, vertices_of
from edgeloom.operators.pagerank import incoming_rank, pagerank, pagerank_step
from edgeloom.operators.paths import adjacency, two_paths
from edgeloom.operators.triangles import (
    closed_two_path_count,
    pair_multiplicity,
    triangle_count,
    triangles,
)

__all__ = [
    "adjacency", "closed_two_path_count", "degrees", "edge_multiplicity", "follower_count",
    "incoming_rank", "max_filter", "pagerank", "pagerank_step", "pair_multiplicity",
    "reverse_edges", "triangle_count", "triangles", "two_path_count", "two_path_degree",
    "two_paths", "vertices_of",
]
