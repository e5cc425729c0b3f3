"""Training-data operators (one module per operator) and their queries.

Nothing outside this subpackage imports it. Shared parts: ``textbatch``
(vectorised word and shingle hashing of Arrow text batches), ``tokens``
(public tokenisers), ``graph`` (distributed connected components) and
``buckets`` (candidate pairs out of skewed hash buckets).
"""
