"""Training-data operators: filtering, deduplication, search, formatting, packing.

Self-contained: nothing else in the library imports this package, and the
package may be removed without touching the rest.
"""
