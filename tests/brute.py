"""Slow and obvious counterparts of the operators, over Python lists of edges."""

from collections import Counter


def closed_two_paths(edges, multiplicity):
    if multiplicity == "distinct":
        edges = {(a, b) for a, b in edges if a != b}
    copies = Counter(edges)
    closed = 0
    for (x, y), p in copies.items():
        for (y2, z), q in copies.items():
            if y == y2 and (z, x) in copies:
                closed += p * q * (copies[z, x] if multiplicity == "all" else 1)
    return closed


def two_paths(edges):
    return Counter((x, y, z) for x, y in edges for y2, z in edges if y == y2)


def triangles(edges):
    simple = {(a, b) for a, b in edges if a != b}
    return sorted(
        (x, y, z) for x, y in simple for y2, z in simple
        if y == y2 and (z, x) in simple and x < y and x < z
    )


def pagerank(edges, vertices, iterations, sink, n, normalize, ranks=None):
    out = Counter(a for a, _ in edges)
    rank = ranks or {v: 0.0 if v == sink else 1.0 / n for v in vertices}
    for _ in range(iterations):
        inc = Counter()
        for a, b in edges:
            if a in rank:
                inc[b] += rank[a] / (out[a] if normalize == "out_degree" else 1)
        total = inc[sink] if sink is not None else 0.0
        if normalize == "out_degree":
            total += sum(r for v, r in rank.items() if v != sink and not out[v])
        rank = {v: 0.0 if v == sink else inc[v] + total / n for v in vertices}
    return rank
