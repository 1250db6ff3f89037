"""Small graphs and plain-Python answers to compare with."""

import random
from collections import Counter, deque


def edge_frame(spark, edges):
    rows = [("c1", a, b) for a, b in edges]
    return spark.createDataFrame(rows, "crawl_id string, src string, dst string")


def id_frame(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def hub_graph(seed=1, n=40, m=150):
    """Random multigraph in which one third of the edges end at one vertex
    and a sixth start at another one."""
    rng = random.Random(seed)
    names = [f"n{i:02d}" for i in range(n)]
    edges = [(rng.choice(names), rng.choice(names)) for _ in range(m // 2)]
    edges += [(rng.choice(names), names[7]) for _ in range(m // 3)]
    edges += [(names[11], rng.choice(names)) for _ in range(m // 6)]
    return edges


def simple(edges):
    return sorted(set(edges))


def nodes(edges):
    return sorted({v for e in edges for v in e})


def distances(edges, start):
    out = {}
    for a, b in set(edges):
        out.setdefault(a, []).append(b)
    dist, sigma = {start: 0}, Counter({start: 1})
    order, queue = [], deque([start])
    parents = {start: []}
    while queue:
        v = queue.popleft()
        order.append(v)
        for w in out.get(v, []):
            if w not in dist:
                dist[w] = dist[v] + 1
                parents[w] = []
                queue.append(w)
            if dist[w] == dist[v] + 1:
                sigma[w] += sigma[v]
                parents[w].append(v)
    return dist, sigma, parents, order


def betweenness(edges):
    all_nodes = nodes(edges)
    n = len(all_nodes)
    total = dict.fromkeys(all_nodes, 0.0)
    for s in all_nodes:
        _, sigma, parents, order = distances(edges, s)
        delta = dict.fromkeys(order, 0.0)
        for w in reversed(order):
            for v in parents[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                total[w] += delta[w]
    scale = 1 / ((n - 1) * (n - 2)) if n > 2 else 1.0
    return {v: x * scale for v, x in total.items()}


def closeness(edges):
    all_nodes = nodes(edges)
    n = len(all_nodes)
    back = [(b, a) for a, b in edges]
    result = {}
    for v in all_nodes:
        dist = distances(back, v)[0]
        total, r = sum(dist.values()), len(dist)
        result[v] = (r - 1) / total * (r - 1) / (n - 1) if total else 0.0
    return result


def components(edges):
    both = edges + [(b, a) for a, b in edges]
    return {v: min(distances(both, v)[0]) for v in nodes(edges)}


def labels(edges, rounds):
    label = {v: v for v in nodes(edges)}
    for _ in range(rounds):
        votes = {}
        for a, b in edges:
            votes.setdefault(b, Counter())[label[a]] += 1
            votes.setdefault(a, Counter())[label[b]] += 1
        label = {v: min(c, key=lambda x: (-c[x], x)) for v, c in votes.items()}
    return label


def pagerank(edges, reset, rounds):
    vertices = nodes(edges)
    out = Counter(a for a, _ in edges)
    rank = dict.fromkeys(vertices, 1.0)
    for _ in range(rounds):
        got = Counter()
        for a, b in edges:
            got[b] += rank[a] / out[a]
        rank = {v: reset + (1 - reset) * got[v] for v in vertices}
    scale = len(vertices) / sum(rank.values())
    return {v: r * scale for v, r in rank.items()}


def pairs_sharing(edges, least):
    targets = {}
    for a, b in set(edges):
        targets.setdefault(a, set()).add(b)
    result = {}
    for a in targets:
        for b in targets:
            if a < b and len(targets[a] & targets[b]) >= least:
                result[(a, b)] = len(targets[a] & targets[b])
    return result
