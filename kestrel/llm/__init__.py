"""Operators for preparing large text corpora.

One module per operator; each is a function ``DataFrame -> DataFrame`` that
reads only the columns it is told to and returns columns of its own, so
extra or clashing columns of the input are never touched.  ``queries`` binds
them to the driver tables.  Nothing outside this package imports it.
"""
