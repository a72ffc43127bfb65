"""The two passes over blocks against a plain version that looks at every pair of blocks."""

import random

from matnworks.llm import extraction
from matnworks.llm.extraction import LINKED, LONG, STOP_WORDS, STOPPED, Block


def shares(block):
    words = [w.strip(".,;:!?\"'()") for w in block.text.lower().split()]
    return block.linked / len(block.text), sum(w in STOP_WORDS for w in words) / len(words)


def plain_labels(blocks):
    """True for text; the rules as the docstrings state them."""
    size = [len(b.text) for b in blocks]
    links, stops = zip(*map(shares, blocks), strict=True) if blocks else ((), ())
    span = range(len(blocks))
    good = [size[i] >= LONG and links[i] <= LINKED and (2 * stops[i] >= STOPPED or size[i] >= 3 * LONG) for i in span]
    held = sum(size[i] for i in span if good[i] and blocks[i].inside)
    apart = sum(size[i] for i in span if good[i] and not blocks[i].inside)
    trusted = any(b.inside for b in blocks) and held >= apart
    first = {}
    for i in span:
        if links[i] > LINKED:
            first[i] = False
        elif size[i] >= LONG and not trusted:
            first[i] = good[i]
        elif size[i] >= LONG:
            first[i] = blocks[i].inside or (stops[i] >= STOPPED and (size[i] >= 3 * LONG or 2 * apart >= held))
    out = []
    for i in span:
        if i in first:
            out.append(first[i])
            continue
        # Blocks of the same region, counted by their places in it.
        region = [k for k in span if not trusted or blocks[k].inside == blocks[i].inside]
        here = region.index(i)
        decided = [(abs(n - here), n > here, first[k]) for n, k in enumerate(region) if k in first]
        left = min((d for d in decided if not d[1]), default=None)
        right = min((d for d in decided if d[1]), default=None)
        sides = [d for d in (left, right) if d]
        if not sides:
            out.append(not trusted or blocks[i].inside)
        elif trusted and blocks[i].inside:
            out.append(len(sides) < 2 or left[2] or right[2])
        elif len({d[2] for d in sides}) == 1:
            out.append(sides[0][2])
        else:
            near = min(d[0] for d in sides)
            out.append(all(d[2] for d in sides if d[0] == near))  # a tie goes
    return out


def some_block(rng, inside):
    words = [rng.choice(["the", "of", "and", "menu", "price", "login", "house", "river"]) for _ in range(rng.choice([1, 3, 8, 20, 60]))]
    if rng.random() < 0.3:
        words = [w for w in words if w not in STOP_WORDS] or ["menu"]
    text = " ".join(words)
    return Block(text, rng.choice([0, 0, 0, len(text) // 2, len(text)]), inside)


def test_labels_equal_the_plain_rules():
    rng = random.Random(7)
    seen = set()
    for _ in range(4_000):
        regions = rng.choice([(False,), (True,), (False, True, False), (True, False, True)])
        page = [some_block(rng, inside) for inside in regions for _ in range(rng.randrange(7))]
        expected = plain_labels([Block(b.text, b.linked, b.inside) for b in page])
        extraction.label(page)
        assert [b.label for b in page] == expected
        seen.add((regions, True in expected, False in expected))
    assert len(seen) > 12


def test_no_block_and_one_block():
    extraction.label([])
    for inside in (False, True):
        page = [Block("Short.", 0, inside)]
        extraction.label(page)
        assert page[0].label is True and plain_labels(page) == [True]
