"""Operations of a training-data pipeline over documents and conversations.

One module per operator; ``queries`` registers them.  Nothing outside this
folder (and ``corpus_pipeline.py``) imports it.
"""
