"""Readers, element decoders and exports."""
