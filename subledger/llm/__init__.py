"""Training-data operators: the corpus operators, their queries and oracles.

Nothing else in the library imports this subpackage. Every operator keeps its
own general interface here; ``registry.py`` derives the digest columns of the
registered ``opN_*`` queries from it.
"""
