"""What a copy is asked to do, checked before anything runs."""
