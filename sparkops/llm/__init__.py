"""Operators for preparing language-model training data. Nothing outside this
package imports it; ``__spark_entry__`` registers its queries when present."""
