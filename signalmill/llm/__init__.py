"""Training-data operators: deduplication, classifiers, pseudonyms, tokens, search and mixing.

Nothing outside this folder imports it. Each module holds one operator; ``catalog`` registers
their queries. Conventions that all operators share:

* a null text counts as empty, whole texts are read, extra columns of the input are ignored;
* rows are returned one for one, repeated rows included;
* what is sent through Python goes in Arrow batches of packed numpy arrays.
"""
