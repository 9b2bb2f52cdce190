"""tokenweave: corpus packing and next-token analytics as Spark jobs.

Text documents become token arrays, every document gets its place in one
global token stream by a two-level prefix sum, the stream is cut into
fixed-size shards (first = validation, rest = training), strided next-token
batches are laid out for any number of readers, a count-based next-token
table is evaluated by cross-entropy, and text is sampled by repeatable
top-k draws.  Every operator is a DataFrame -> DataFrame function.
"""

from tokenweave.params import PackParams

__all__ = ["PackParams"]
