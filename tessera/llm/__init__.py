"""Training-data operators: deduplication, sharding, classifiers, decontamination, search, tokenizing.

One module per operator.  ``queries`` binds each of them to the driver's tables; nothing
outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
