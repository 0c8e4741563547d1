"""Queries over the star-schema tables: the library's operators on fleet frames derived from them."""
