"""Where inputs come from: directory files, configuration, and the test view over order lines."""
