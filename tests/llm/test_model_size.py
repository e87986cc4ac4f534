"""The model that every task of operator 9 holds."""

import pickle

import numpy as np

from landsales.llm.ppm import ORDER, Lookup, Trie


def _trie(n):
    keys = np.unique(np.random.default_rng(7).integers(0, 1 << 48, n).astype(np.uint64))
    orders = [(keys, np.arange(1, len(keys) + 1))]
    for k in range(ORDER - 1, -1, -1):
        short, place = np.unique(orders[0][0] & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
        orders.insert(0, (short, np.bincount(place, orders[0][1]).astype(np.int64)))
    return Trie(orders)


def test_lookup_finds_every_key_and_no_other():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 5000).astype(np.uint64))
    table = Lookup(keys[::2], np.arange(len(keys[::2])) * 0.5)
    values, known = table.find(np.r_[keys, keys[:1]])
    assert known.tolist() == [n % 2 == 0 for n in range(len(keys))] + [True]
    assert values[:-1][::2].tolist() == [n * 0.5 for n in range(len(keys[::2]))] and not values[1::2][:-1].any()
    none, known = Lookup(keys[:0], np.zeros(0)).find(keys[:3])
    assert none.tolist() == [0, 0, 0] and not known.any()


def test_the_table_of_grams_is_small():
    """Before, a table of keys and values in their slots had up to 68 bytes a gram, and its keys twice."""
    trie = _trie(70_000)
    assert len(pickle.dumps(trie.known, 5)) < 36 * len(trie.keys[-1])
    assert len(pickle.dumps((trie.keys, trie.known), 5)) - len(pickle.dumps(trie.keys, 5)) < 28 * len(trie.keys[-1])


def test_numbers_beyond_32_bits_stay():
    keys = [np.zeros(1, np.uint64)] * (ORDER + 1)
    trie = Trie([(k, np.asarray([1 << 40])) for k in keys])
    assert trie.counts[0][0] == trie.total[0][0] == 1 << 40
