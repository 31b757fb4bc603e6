"""Tables that operators read, and catalogue maintenance."""
