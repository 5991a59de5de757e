"""Plain single-machine versions of the vector operators, for small inputs."""

import numpy as np


def distances(x):
    x = np.asarray(x, dtype=float)
    return np.array([np.sqrt(((x - row) ** 2).sum(axis=1)) for row in x])


def knn(x, k, metric):
    x = np.asarray(x, dtype=float)
    if metric == "cosine":
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        d = distances(x) ** 2 / 2
    else:
        d = distances(x)
    return [
        [j for _, j in sorted((d[i, j], j) for j in range(len(x)) if j != i)[:k]] for i in range(len(x))
    ]


def spanning_tree(n, edges):
    """Kruskal over (w, i, j)."""
    head = list(range(n))

    def find(v):
        while head[v] != v:
            head[v] = head[head[v]]
            v = head[v]
        return v

    tree = []
    for w, i, j in sorted(edges):
        a, b = find(i), find(j)
        if a != b:
            head[a] = b
            tree.append((w, i, j))
    return tree


def reachability_tree(x, min_samples):
    d = distances(x)
    core = np.sort(d, axis=1)[:, min_samples]
    w = np.maximum(np.maximum(core[:, None], core[None]), d)
    n = len(d)
    return spanning_tree(n, [(w[i, j], i, j) for i in range(n) for j in range(i + 1, n)])


def hdbscan(x, min_cluster_size, min_samples, method="eom"):
    """Labels from the full single-linkage tree, condensed from the top down."""
    n = len(x)
    head, node = list(range(n)), list(range(n))
    kids, height, size = {}, {}, {i: 1 for i in range(n)}

    def find(v):
        while head[v] != v:
            head[v] = head[head[v]]
            v = head[v]
        return v

    top = n
    for w, i, j in reachability_tree(x, min_samples):
        a, b = find(i), find(j)
        kids[top], height[top], size[top] = (node[a], node[b]), w, size[node[a]] + size[node[b]]
        head[a], node[b] = b, top
        top += 1

    def leaves(v):
        todo, out = [v], []
        while todo:
            u = todo.pop()
            if u < n:
                out.append(u)
            else:
                todo += kids[u]
        return out

    density = lambda w: np.inf if w == 0 else 1 / w
    clusters = []
    todo = [(top - 1, 0.0, None)]
    while todo:
        v, birth, parent = todo.pop()
        me = {"birth": birth, "points": {}, "kids": [], "inner": 0.0}
        number = len(clusters)
        clusters.append(me)
        if parent is not None:
            clusters[parent]["kids"].append(number)
        while True:
            if v < n:
                me["points"][v] = np.inf
                break
            left, right = kids[v]
            at = density(height[v])
            big = [u for u in (left, right) if size[u] >= min_cluster_size]
            if len(big) == 2:
                me["inner"] = size[v] * (at - birth)
                todo += [(left, at, number), (right, at, number)]
                break
            for u in (left, right):
                if u not in big:
                    me["points"].update((p, at) for p in leaves(u))
            if not big:
                break
            v = big[0]
    stability = [sum(p - c["birth"] for p in c["points"].values()) + c["inner"] for c in clusters]
    chosen, best = [False] * len(clusters), [0.0] * len(clusters)
    for c in range(len(clusters) - 1, -1, -1):
        below = sum(best[k] for k in clusters[c]["kids"])
        if c == 0 or (clusters[c]["kids"] and (method == "leaf" or below > stability[c])):
            best[c] = below
        else:
            best[c], chosen[c] = stability[c], True
    label = np.full(n, -1)

    def mark(c, inside):
        if inside < 0 and chosen[c]:
            inside = c
        for p in clusters[c]["points"]:
            label[p] = inside
        for k in clusters[c]["kids"]:
            mark(k, inside)

    if len(clusters) > 1:
        mark(0, -1)
    names = sorted(
        {v for v in label if v >= 0}, key=lambda v: (-(label == v).sum(), np.nonzero(label == v)[0][0])
    )
    number = {v: i for i, v in enumerate(names)} | {-1: -1}
    return np.array([number[v] for v in label])


def silhouette(x, label):
    d = distances(x)
    keep = label != -1
    d, label = d[keep][:, keep], label[keep]
    out = []
    for i in range(len(label)):
        own = (label == label[i]).sum()
        if own == 1:
            out.append(0.0)
            continue
        a = d[i, label == label[i]].sum() / (own - 1)
        b = min(d[i, label == k].mean() for k in set(label) if k != label[i])
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def average_linkage(vectors: np.ndarray, n_groups: int) -> np.ndarray:
    """First member of the group per vector after merging the closest groups one by one."""
    n = len(vectors)
    group = np.arange(n)
    if n <= max(n_groups, 1):
        return group
    units = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    dist = np.round(1.0 - units @ units.T, 12)
    np.fill_diagonal(dist, np.inf)
    size = np.ones(n)
    for _ in range(n - max(n_groups, 1)):
        a, b = divmod(int(dist.argmin()), n)
        a, b = min(a, b), max(a, b)
        mixed = (size[a] * dist[a] + size[b] * dist[b]) / (size[a] + size[b])
        dist[a], dist[:, a] = mixed, mixed
        dist[a, a] = np.inf
        dist[b], dist[:, b] = np.inf, np.inf
        size[a] += size[b]
        group[group == b] = a
    return group
