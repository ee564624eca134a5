"""Part of Skeinwright: see the modules."""
