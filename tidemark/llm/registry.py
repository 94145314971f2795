"""The registered queries of the package and their SQL."""

from . import (
    byte_bpe,
    decontaminate,
    mixing,
    packed,
    prefix_trie,
    pseudonyms,
    quality,
    runs,
    simhash,
    substrings,
    suffixes,
    token_counts,
    urls,
)

SECTIONS = (
    decontaminate, simhash, token_counts, urls, quality, substrings, pseudonyms, packed, suffixes, mixing,
    byte_bpe, runs, prefix_trie,
)


def queries():
    return {name: run for section in SECTIONS for name, run in section.QUERIES.items()}


def oracle_sql():
    return {name: sql for section in SECTIONS for name, sql in section.ORACLES.items()}
