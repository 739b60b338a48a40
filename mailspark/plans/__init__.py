"""The stages, composed from operators."""
