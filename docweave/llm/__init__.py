"""Training-data operators: token output, de-duplication, packing, filtering, formatting and scoring.

Nothing outside this subpackage imports it; the library works without it.
"""
