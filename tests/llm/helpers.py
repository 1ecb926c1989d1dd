"""Odd rows and plain searches the tests share."""

import itertools

#: Rows every operator must take: null, empty, blank, long and repeated texts, a null identifier,
#: a repeated row.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "One line."), (4, "One line."), (None, "One line."), (5, "é😀 ß\x00\x1c　中文"),
    (6, "word " * 30_000), (7, "x" * 100_000), (8, "a\n" * 5_000), (9, "ONE LINE."), (10, "<|endoftext|> <s> </s>"),
]


def by_links(n, links):
    """The smallest member of each one's class under ``links``, by plain search."""
    near = {i: set() for i in range(n)}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    root = {}
    for i in range(n):
        if i in root:
            continue
        stack = [i]
        while stack:
            x = stack.pop()
            if x not in root:
                root[x] = i
                stack += near[x]
    return [root[i] for i in range(n)]


def pairs(n):
    return itertools.combinations(range(n), 2)
