"""Operators for preparing text as training data.

Ten operators (toxicity, token files, secret scan, packing, n-gram Jaccard
join, personal data, chat formatting, line quality, source mixing, document
fingerprints), their registered queries (``queries``) and the stages that
``corpus_pipeline.py`` chains. Nothing else in the library imports this
package.
"""
