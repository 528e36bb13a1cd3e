"""Operations that prepare training data at corpus scale.

Nothing outside this subpackage imports it.  The operators live in one module
each; :mod:`webloom.llm.registry` turns them into the ``opN_<name>`` queries.
"""
