"""Operators over documents and vectors for preparing large training corpora.

Each module holds one operator as functions from DataFrame to DataFrame; ``queries`` applies them to
whole tables. Nothing outside this folder imports it.
"""
