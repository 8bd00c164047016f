"""Operators for preparing large training corpora.

Nothing outside this subpackage imports it.  Each module holds one operator with a general
interface; ``queries`` applies them to whole tables with production parameters.
"""
