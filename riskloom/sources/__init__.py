"""Tables, versioned datasets, feature views and the frames derived from the test tables."""
