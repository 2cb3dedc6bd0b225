"""Training-data operators over document, page and conversation tables.

One module per operator; ``queries`` registers them. Nothing else in the library imports
this subpackage.
"""
