"""From specs to one lazy DataFrame."""
