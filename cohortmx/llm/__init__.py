"""Training-data operators over a ``documents`` table (doc_id, text, ...).

Nothing outside this folder (but ``corpus_pipeline.py`` at the top of the
repository, which belongs to it) imports it.
"""
