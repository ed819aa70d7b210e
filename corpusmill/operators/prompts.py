"""Prompt texts of the question-bank sources."""

# ---------------------------------------------------------------------------
# These strings must equal the reference's prompts exactly
# (spelling kept as published, including "inidiquement" and "Tu est").
# ---------------------------------------------------------------------------
INSTRUCTIONS = {
    "MCQU": "Tu es un modèle expert en médecine et en sciences biomédicales. Ta tâche consiste à répondre correctement à des QCMs médicaux comportant une seule bonne réponse. Lis attentivement la question et les propositions, puis inidiquement uniquement l’option correcte. Ne donne aucune explication sauf si cela t’est explicitement demandé.",
    "MCQM": "Tu es un modèle expert en médecine et en sciences biomédicales. Ta tâche consiste à répondre correctement à des QCMs médicaux comportant plusieurs bonnes réponses possibles (de 2 à 5). Lis attentivement la question et les propositions, puis indique les réponses correctes. Ne donne aucune explication sauf si cela t’est explicitement demandé.",
    "MCQall": "Tu es un modèle expert en médecine et en sciences biomédicales. Ta tâche consiste à répondre correctement à des QCMs médicaux comportant plusieurs bonnes réponses possibles (de 1 à 5). Lis attentivement la question et les propositions, puis indique la ou les réponses correctes. Ne donne aucune explication sauf si cela t’est explicitement demandé.",
}
SUBJECT_SINGLE = "Tu est un modèle expert en médecine et en sciences biomédicales, plus particulièrement en {subject}. Ta tâche consiste à répondre correctement à des QCMs médicaux comportant une seule bonne réponse. Lis attentivement la question et le contexte clinique quand il t'est donné pour t'aider à choisir la bonne réponse parmis les 5 proposées. Inidiquement uniquement la réponse correcte, sans justification."
SUBJECT_MULTIPLE = "Tu est un modèle expert en médecine et en sciences biomédicales, plus particulièrement en {subject}. Ta tâche consiste à répondre correctement à des QCMs médicaux comportant plusieurs bonnes réponses (minimum 2). Lis attentivement la question et le contexte clinique quand il t'est donné pour t'aider à choisir les bonnes réponses parmis les 5 proposées. Inidiquement uniquement les réponses correctes, sans justification."
SINGLE_ANSWER_DATA_DIR = "mcqu"
ANSWER_LETTERS = ["A", "B", "C", "D", "E"]
ANSWER_COLUMNS = ["answer_a", "answer_b", "answer_c", "answer_d", "answer_e"]
# Python renders a missing value inside a %-format or f-string as this text.
NONE_TEXT = "None"
# Layout of the generated prompts ({...} marks a substituted value).
INSTRUCTION_LAYOUT = "<instruction>\n{instruction}\n</instruction>"
INPUT_LAYOUT = (
    "<input>\n\t{case}<question>\n\t{question}\n\t</question>\n\t<answers>\n\tA. {a}\n\tB. {b}\n\tC. {c}"
    "\n\tD. {d}\n\tE. {e}\n\t</answers>\n</input>"
)
CASE_LAYOUT = "<clinical_case>\n\t{case}\n\t</clinical_case>\n\t"
OUTPUT_LAYOUT = "<output>\n{answers}\n</output>"
MARKDOWN_LAYOUT = "### Question \n{question} \nA. {a} \nB. {b} \nC. {c} \nD. {d} \nE. {e} \n### Réponse.s"
MARKDOWN_ANSWER_LAYOUT = "\n{letter}. {answer}"
ANSWER_SEPARATOR = ", "
# ---------------------------------------------------------------------------
